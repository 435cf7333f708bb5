"""Text cleaning and category recoding, driven by the tables of values below."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---- Fixed values -------------------------------------------------------------------

# Misspelled suburb -> name in the suburb file.
SUBURB_ALIASES = {"WAVERLY": "WAVERLEY"}

# First day whose extracts already use the new property names.
RECODE_CUTOFF = "2020-08-01"

HOTEL_KINDS = ("Boutique hotel", "Hotel", "Aparthotel")

# Whole homes whose old and new names are the same.
STANDALONE_HOMES = (
    "Barn", "Boat", "Bus", "Camper/RV", "Castle", "Cave", "Dome house", "Earth house",
    "Farm stay", "Island", "Tent", "Tiny house", "Train", "Treehouse", "Yurt",
)

# Whole homes with a new name of their own.
RENAMED_HOMES = {"Other": "Entire place", "Casa particular (Cuba)": "Casa particular"}

WHOLE_HOME = "Entire home/apt"
ROOM_PREFIXES = {
    "Private room": "Private room in ",
    "Shared room": "Shared room in ",
    "Hotel room": "Room in ",
}

# -------------------------------------------------------------------------------------


def lookup(value: Column, table: dict[str, str], otherwise: Column) -> Column:
    """Replace the values listed in ``table``; everything else is ``otherwise``."""
    first, *rest = [(value == key, F.lit(new)) for key, new in table.items()]
    return reduce(lambda c, hit: c.when(*hit), rest, F.when(*first)).otherwise(otherwise)


def blank_to_null(text: Column) -> Column:
    return F.nullif(F.trim(text), F.lit(""))


def upper_name(text: Column) -> Column:
    return F.upper(F.trim(text))


def suburb_name(text: Column, aliases: dict[str, str] | None = None) -> Column:
    """Upper-case suburb with known misspellings repaired; blank gives NULL."""
    name = F.nullif(upper_name(text), F.lit(""))
    return lookup(name, SUBURB_ALIASES if aliases is None else aliases, name)


def flag(text: Column) -> Column:
    """'t' is true, 'f' is false, anything else (also NULL) is NULL."""
    return F.when(text.isin("t", "f"), text == "t")


def modern_property_type(kind: Column, room: Column, seen: Column, cutoff: str) -> Column:
    """Old property names in the new style, for rows seen before ``cutoff`` or undated.

    New names tell how the place is let ("Entire loft", "Private room in loft").  Hotels
    are rooms whatever the room type says; a whole home keeps, renames or prefixes its
    kind; an unspecific kind is named after the room type; a room type without a prefix
    leaves the kind alone.  ``seen`` must be the date in the file, not the clamped one:
    a late row of an old file already carries its new name.
    """
    small = F.lower(kind)
    whole = F.when(kind.isin(*STANDALONE_HOMES), kind).otherwise(
        lookup(kind, RENAMED_HOMES, F.concat(F.lit("Entire "), small)))
    prefix = lookup(room, ROOM_PREFIXES, F.lit(None))
    part = F.when(kind == "Other", room).otherwise(F.coalesce(F.concat(prefix, small), kind))
    old = (F.when(kind.isin(*HOTEL_KINDS), F.concat(F.lit(ROOM_PREFIXES["Hotel room"]), small))
           .otherwise(F.when(room == WHOLE_HOME, whole).otherwise(part)))
    return F.when(seen >= F.lit(cutoff).cast("date"), kind).otherwise(old)
