"""Field names and record-type codes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import col

#: Phrases whose brackets carry meaning, and what they become.
PHRASES = (("WAGM (ARM pools only)", "WAGM_ARM"), ("WAGM (AR pools only)", "WAGM_AR"), ("Issuer Name (Long Name)", "Issuer_Name_Long"), ("Issuer Name (Short Name)", "Issuer_Name_Short"))
#: Characters and what they become, in this order.
CHARACTERS = (("%", "Percent"), ("/", "_or_"), ("=", "_equals_"), ("-", "_"), ("–", "_"), ("+", "_Plus"), ("*", ""), (",", ""), ("'", ""), ('"', ""), (" ", "_"))
#: The ways in which a record type is named, the first that fits holds.
CODE_PATTERNS = (
    r"(?iU)record\s*type\s*=\s*([A-Z0-9]+)",
    r"(?iU)record\s*type\s*\(\s*([A-Z0-9]+)\s*=",
    r"(?iU)record\s*type\s+([A-Z0-9]+)\s*=",
    r"(?iU)record\s*type\s*\(\s*([A-Z0-9]+)\s*\)",
    r"(?iU)record\s*type\s+([A-Z0-9]+)",
)


def record_type_code(c: str | Column) -> Column:
    """Record-type code that a field name states, upper case; null if it states none or is just the words."""
    text = col(c)
    found = [F.nullif(F.upper(F.regexp_extract(text, p, 1)), F.lit("")) for p in CODE_PATTERNS]
    return F.when(F.lower(F.trim(text)) == "record type", F.lit(None)).otherwise(F.coalesce(*found))


def standard_name(c: str | Column) -> Column:
    """A field name as an identifier: brackets go, signs become words, spaces underscores."""
    flat = F.translate(col(c), "\r\n", "  ")
    out = flat
    for old, new in PHRASES:
        out = F.replace(out, F.lit(old), F.lit(new))
    out = F.regexp_replace(out, r"\([^)]*\)", "")
    for old, new in CHARACTERS:
        out = F.replace(out, F.lit(old), F.lit(new))
    out = F.when(out.rlike(r"(?U)^\d"), F.concat(F.lit("Field_"), out)).otherwise(out)
    out = F.regexp_replace(F.regexp_replace(out, "_+", "_"), "^_|_$", "")
    return F.when(F.lower(flat).contains("filler"), F.lit("Filler")).when(flat.startswith("Record Type"), F.lit("Record Type")).otherwise(out)


def unused(name: str, used: set[str]) -> str:
    """name, or name_1, name_2 ...: the first that is not used yet, whatever the case; it is used from now on."""
    new, k = name, 0
    while new.lower() in used:
        k += 1
        new = f"{name}_{k}"
    used.add(new.lower())
    return new


def distinct_names(names: list[str]) -> list[str]:
    """Headers on one line with single spaces; of equal names, whatever their case, the later ones get _1, _2 ..., and no name twice."""
    used: set[str] = set()
    return [unused(" ".join(n.replace("\r", " ").replace("\n", " ").split()), used) for n in names]
