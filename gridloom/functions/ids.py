"""Identifiers in text: extraction, seeds, names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed patterns.
UUID = "([0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12})"
HEX32 = "(?<![0-9a-fA-F])([0-9a-fA-F]{32})(?![0-9a-fA-F])"
QUOTED_UID = "['\"]save_uid['\"]\\s*:\\s*['\"]([0-9a-fA-F\\-]{36})['\"]"
LITERAL_UID = "['\"]save_uid['\"]\\s*:\\s*(?:'([^']*)'|\"([^\"]*)\")"


def first_match(text: Column, pattern: str, group: int = 1) -> Column:
    """The first match's group, null without a match."""
    return F.nullif(F.regexp_extract(text, pattern, group), F.lit(""))


def literal_uid(meta: Column) -> Column:
    """``save_uid`` of a dictionary written as text, case kept; null if there is none."""
    return F.coalesce(first_match(meta, LITERAL_UID, 1), first_match(meta, LITERAL_UID, 2))


def save_uid(meta: Column) -> Column:
    """Lower-cased ``save_uid``: as a dictionary entry, else any quoted one of 36 characters, else the first UUID."""
    text = F.trim(meta)
    return F.lower(F.coalesce(literal_uid(text), first_match(text, QUOTED_UID), first_match(text, UUID)))


def as_text(value: Column, kind: str) -> Column:
    """Structures as JSON, other values as text, null as empty."""
    return F.coalesce(F.to_json(value) if kind.startswith(("struct", "array", "map")) else value.cast("string"), F.lit(""))


def stable_seed(path: Column, base: int = 0) -> Column:
    """Seed of a path: 32 bits of its SHA-1 plus a base, modulo 2^31 - 1."""
    return F.pmod(F.conv(F.substring(F.sha1(path), 1, 8), 16, 10).cast("long") + F.lit(base), F.lit(2147483647).cast("long"))


def part_name(path: Column) -> Column:
    """Name of the part file of a path: 16 digits of its SHA-1 and its stem."""
    return F.concat(F.substring(F.sha1(path), 1, 16), F.lit("__"), stem(path), F.lit(".json"))


def stem(path: Column) -> Column:
    return F.regexp_replace(base_name(path), "(?<=.)\\.[^.]*$", "")


def base_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def parent(path: Column) -> Column:
    return F.regexp_replace(path, "/?[^/]*$", "")


def object_key(path: Column) -> Column:
    """parent:name of a path."""
    return F.concat_ws(":", base_name(parent(path)), base_name(path))


def swap_root(path: Column, old: str, new: str) -> Column:
    return F.when(path.startswith(old), F.concat(F.lit(new), F.substring(path, len(old) + 1, 1 << 30))).otherwise(path)


def tar_name(name: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(name, "^(\\./)+", ""), "^/+|/+$", "")


def optional_path(path: Column) -> Column:
    return F.when(F.lower(F.trim(path)).isin("", "none"), F.lit(None)).otherwise(path)


def flat_name(path: Column) -> Column:
    return F.when(path.isin("", "."), F.lit("root")).otherwise(F.replace(path, F.lit("/"), F.lit("__")))


def view_name(view: Column) -> Column:
    return F.format_string("view_%02d", view.cast("int"))


def frame_tag(frame: Column) -> Column:
    return F.format_string("%03d", frame.cast("int"))


def int_list(text: Column) -> Column:
    """A comma list of integers; blanks are left out."""
    parts = F.filter(F.transform(F.split(text, ","), lambda x: F.trim(x)), lambda x: x != "")
    return F.transform(parts, lambda x: x.cast("long"))


def natural_key(text: Column, width: int = 20) -> Column:
    """Sorts digit runs as numbers and the rest without case: runs are padded to ``width`` digits."""
    parts = F.regexp_extract_all(F.lower(text), F.lit("(\\d+|\\D+)"), F.lit(1))
    return F.array_join(F.transform(parts, lambda p: F.when(p.rlike("^\\d"), F.lpad(F.regexp_replace(p, "^0+(?=.)", ""), width, "0")).otherwise(p)), "")
