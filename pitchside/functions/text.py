"""String expressions: whitespace strip, alias maps, codes, rule-based groups."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the reference for identical results.
# Team-name substring aliases, applied in this order (regex, substring match).
TEAM_ALIASES: tuple[tuple[str, str], ...] = (
    ("USA", "United States"),
    ("Korea Republic", "South Korea"),
    ("Korea DPR", "North Korea"),
    ("IR Iran", "Iran"),
    ('rn">West Germany', "West Germany"),
    ('rn">', ""),
)

# Country names of the readings source, exact-value aliases.
COUNTRY_ALIASES: dict[str, str] = {
    "United States": "United States",
    "Korea": "South Korea",
    "Iran (Islamic Republic of)": "Iran",
    "Republic of Korea": "South Korea",
    "Democratic People's Republic of Korea": "North Korea",
}

# Confederation by ordered substring lists; the first list with a hit wins.
CONFEDERATION_RULES: tuple[tuple[str, tuple[str, ...]], ...] = (
    ("UEFA", ("Germany", "France", "Italy", "Spain", "England", "Netherlands", "Portugal",
              "Belgium", "Russia", "Poland", "Ukraine", "Croatia", "Sweden", "Switzerland",
              "Austria", "Czech", "Serbia")),
    ("CONMEBOL", ("Brazil", "Argentina", "Uruguay", "Colombia", "Chile", "Paraguay", "Peru",
                  "Ecuador", "Bolivia", "Venezuela")),
    ("CONCACAF", ("USA", "United States", "Mexico", "Canada", "Costa Rica")),
    ("CAF", ("Nigeria", "Ghana", "Cameroon", "Senegal", "South Africa")),
    ("AFC", ("Japan", "South Korea", "Australia", "Iran", "Saudi")),
)
DEFAULT_GROUP = "Other"

# every character that Unicode counts as white space, and the ASCII separators
WHITESPACE = "".join(chr(c) for c in (*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
                                      0x2028, 0x2029, 0x202F, 0x205F, 0x3000))


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_ws(c: str | Column) -> Column:
    """Strip leading/trailing whitespace of any kind (plain ``trim`` only strips
    blanks).  A character-set trim, not a regex: no per-row pattern matching."""
    return F.trim(_col(c), F.lit(WHITESPACE))


def alias_regex(c: str | Column, aliases: Sequence[tuple[str, str]] = TEAM_ALIASES) -> Column:
    """Apply substring/regex replacements one after the other, in the given order.

    Rows matching none of the patterns skip the chain (one combined test): if
    the first pattern cannot match, no replacement happens and so on down the
    chain, so the guard never changes a result."""
    col = _col(c)
    if not aliases:
        return col
    out = col
    for pattern, repl in aliases:
        out = F.regexp_replace(out, pattern, repl)
    any_hit = "|".join(f"(?:{p})" for p, _ in aliases)
    return F.when(col.rlike(any_hit), out).otherwise(col)


def alias_exact(c: str | Column, aliases: Mapping[str, str] = COUNTRY_ALIASES) -> Column:
    """Replace whole values found in a small literal map; others pass through.

    The map is a literal expression (no join), so it costs one hash lookup per
    row and never moves data."""
    col = _col(c)
    if not aliases:
        return col
    lookup = F.create_map(*[F.lit(x) for kv in aliases.items() for x in kv])
    return F.coalesce(F.try_element_at(lookup, col), col)


def title_case(c: str | Column) -> Column:
    return F.initcap(_col(c))


def code_prefix(c: str | Column, n: int = 3) -> Column:
    """First ``n`` characters, upper-cased (team codes)."""
    return F.upper(F.substring(_col(c), 1, n))


def infer_group(c: str | Column,
                rules: Iterable[tuple[str, Iterable[str]]] = CONFEDERATION_RULES,
                default: str = DEFAULT_GROUP) -> Column:
    """First rule whose substring list hits the value; else ``default``."""
    col = _col(c)
    out = None
    for label, needles in rules:
        hit = None
        for needle in needles:
            cond = col.contains(needle)
            hit = cond if hit is None else (hit | cond)
        if hit is None:
            continue
        out = F.when(hit, F.lit(label)) if out is None else out.when(hit, F.lit(label))
    return F.lit(default) if out is None else out.otherwise(F.lit(default))


def null_default(c: str | Column, default: str = "Unknown") -> Column:
    return F.coalesce(_col(c), F.lit(default))
