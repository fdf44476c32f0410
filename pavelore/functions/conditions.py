"""Conditional mappings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..fixed import ICON_CLASSES, UNKNOWN_ICON_CLASS


def bool_to_int(flag: Column) -> Column:
    """False to 0, true to 1, null stays null."""
    return flag.cast("int")


def char_at(text: Column, position: int) -> Column:
    """The character at a 1-based position."""
    return F.substring(text, position, 1)


def day_night(icon: Column) -> Column:
    """``Day`` when the third character of the icon is ``d``, else (null included) ``Night``."""
    return F.when(char_at(icon, 3) == "d", "Day").otherwise("Night")


def icon_class(icon: Column) -> Column:
    """Weather class of an icon such as ``10d``."""
    chain = F
    for number, name in ICON_CLASSES.items():
        chain = chain.when(icon.isin(f"{number}d", f"{number}n"), name)
    return chain.otherwise(UNKNOWN_ICON_CLASS)
