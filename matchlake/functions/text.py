"""Names, seasons, timestamps in text form."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from matchlake.constants import TEAM_ALIASES


def canonical_name(name: Column, aliases: dict[str, str] | None = None) -> Column:
    """Trim, then replace a known alias. NULL and the empty string pass through."""
    aliases = TEAM_ALIASES if aliases is None else aliases
    trimmed = F.trim(name)
    if not aliases:
        return trimmed
    lookup = F.create_map(*[F.lit(x) for x in chain.from_iterable(aliases.items())])
    return F.coalesce(F.element_at(lookup, trimmed), trimmed)


def season_of(season: Column, first_date: Column) -> Column:
    """The stated season, else the year of the first date; of "2020/21" the first part."""
    stated = F.when(season != "", season)
    first_year = F.split_part(first_date, F.lit("-"), F.lit(1))
    return F.split_part(F.trim(F.coalesce(stated, first_year)), F.lit("/"), F.lit(1))


def parse_iso(text: Column) -> Column:
    """ISO text to a zone-less timestamp, ignoring a 'Z'; NULL when it does not parse."""
    return F.try_to_timestamp(F.replace(text, F.lit("Z"), F.lit(""))).cast("timestamp_ntz")


def filled(value: Column) -> Column:
    """Neither NULL nor empty."""
    return value.isNotNull() & (value != "")


def event_season(metadata: Column) -> Column:
    """The season named in an event's JSON metadata."""
    return F.get_json_object(metadata, "$.season")
