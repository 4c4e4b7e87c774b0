"""String expressions: names, ids, key=value lists, coordinate lists."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .geometry import POINT


def file_prefix(name: Column) -> Column:
    """Before the first underscore, upper-cased."""
    return F.upper(F.split_part(name, F.lit("_"), F.lit(1)))


def strip_suffix(name: Column, suffixes: list[str]) -> Column:
    """Without the first of the suffixes that it ends with."""
    out = None
    for s in suffixes:
        cut = F.substr(name, F.lit(1), F.length(name) - len(s))
        out = F.when(name.endswith(s), cut) if out is None else out.when(name.endswith(s), cut)
    return out.otherwise(name)


def key_values(text: Column) -> Column:
    """k=v|k=v to a map."""
    return F.str_to_map(text, F.lit("\\|"), F.lit("="))


def tolerant_int(text: Column) -> Column:
    return text.try_cast("int")


def xml_id(text: Column) -> Column:
    return F.translate(text, " :/", "___")


def lat_lng(text: Column) -> Column:
    part = lambda k: F.trim(F.split_part(text, F.lit(","), F.lit(k))).try_cast("double")
    return F.struct(part(1).alias("lat"), part(2).alias("lng"))


def pos_list(text: Column) -> Column:
    """Space-separated coordinates to a ring without its closing vertex; fewer than nine values: null."""
    v = F.transform(F.split(F.trim(text), r"\s+"), lambda s: s.try_cast("double"))
    ring = F.transform(F.sequence(F.lit(0), F.greatest(F.floor(F.size(v) / 3), F.lit(1)).cast("int") - 1), lambda i: F.struct(*(F.try_element_at(v, i * 3 + k + 1).alias(c) for k, c in enumerate("xyz"))))
    closed = F.try_element_at(ring, F.lit(1)) == F.try_element_at(ring, F.lit(-1))
    return F.when(F.size(v) >= 9, F.when(closed, F.slice(ring, 1, F.greatest(F.size(ring) - 1, F.lit(1)))).otherwise(ring)).cast(f"array<{POINT}>")


def format_pos_list(ring: Column) -> Column:
    """Six decimals, closed."""
    one = lambda p: F.format_string("%.6f %.6f %.6f", p["x"], p["y"], p["z"])
    return F.array_join(F.transform(F.concat(ring, F.slice(ring, 1, 1)), one), " ")


def output_name(name: Column, kind: str) -> Column:
    """Names of results: labelled_<name>, color_segmented_<name>, <base>_LOD3.json of a model."""
    base = F.regexp_replace(name, "[.][^.]*$", "")
    return {"labelled": F.concat(F.lit("labelled_"), name), "segmented": F.concat(F.lit("color_segmented_"), name), "lod3": F.concat(base, F.lit("_LOD3.json"))}[kind]


def tile_location(name: Column) -> Column:
    """The location prefix of <location>_<face>.<extension>."""
    return F.regexp_extract(name, r"^(.*)_(front|back|left|right|up|down|top|bottom)\.(jpg|jpeg|png)$", 1)
