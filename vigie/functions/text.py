"""Text Column helpers: name normalization, date-string repair, canonical commune names.

All are built-in Column expressions (``translate``, ``regexp_replace``, ``lower``...), so they stay inside
whole-stage codegen; no Python UDF.
"""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

# Letters with a stroke, which Unicode does not decompose, and ligatures expanded to two letters.
STROKED = {"Ø": "O", "ø": "o", "Ł": "L", "ł": "l", "Đ": "D", "đ": "d", "Ħ": "H", "ħ": "h", "Ŧ": "T", "ŧ": "t", "ı": "i"}
LIGATURES = [("Œ", "OE"), ("œ", "oe"), ("Æ", "AE"), ("æ", "ae"), ("ß", "ss"), ("ẞ", "SS"), ("Þ", "TH"), ("þ", "th"), ("Ĳ", "IJ"), ("ĳ", "ij")]


def _folding() -> dict[str, str]:
    """Every Latin letter that Unicode decomposes into an ASCII letter and marks, with that letter."""
    out = dict(STROKED)
    for code in [*range(0xC0, 0x250), *range(0x1E00, 0x1F00)]:
        base, *marks = unicodedata.normalize("NFD", chr(code))
        if marks and base.isascii():
            out[chr(code)] = base
    return out


FOLDING = _folding()


def unaccent(c: Column) -> Column:
    """Accented Latin letters to ASCII ones; combining marks go."""
    out = F.translate(c, "".join(FOLDING) + "".join(map(chr, range(0x300, 0x370))), "".join(FOLDING.values()))
    for src, dst in LIGATURES:
        out = F.replace(out, F.lit(src), F.lit(dst))
    return out


def normalize_text(c: Column) -> Column:
    """unaccent → every char outside [a-zA-Z0-9 newline . space] becomes a space → lower → runs of whitespace to one
    space (no trim)."""
    out = F.regexp_replace(unaccent(c), r"[^a-zA-Z0-9\n. ]", " ")
    out = F.lower(out)
    return F.regexp_replace(out, r"\s+", " ")


def repair_short_date(c: Column) -> Column:
    """``d/m/yy`` → ``20yy-m-d 00:00:00``; any other text is returned unchanged."""
    pat = r"^(\d{1,2})/(\d{1,2})/(\d{2})$"
    return F.when(
        c.rlike(pat),
        F.concat(F.lit("20"), F.regexp_extract(c, pat, 3), F.lit("-"), F.regexp_extract(c, pat, 2), F.lit("-"),
                 F.regexp_extract(c, pat, 1), F.lit(" 00:00:00")),
    ).otherwise(c)


def parse_strict_timestamp(c: Column) -> Column:
    """Strict ``Y-m-d H:M:S`` parse (1- or 2-digit month/day); unparsable → NULL."""
    return F.try_to_timestamp(c, F.lit("yyyy-M-d HH:mm:ss"))


# Commune-name repair of the enforcement-report log, applied in this order.
# Literal character replacements (the first two are applied before/after upper-casing).
COMMUNE_CHAR_RULES = [("_", "-"), ("'", "-"), ("-/-", "-"), ("’", "-")]
# Literal substring replacements, in order.
COMMUNE_NAME_RULES = [
    ("CAP-D-AGDE", "AGDE"),
    ("MONS-LA-TRIVALLE", "MONS"),
    ("SAINT-CHRISTOL-ENTRE-VIGNES", "ENTRE-VIGNES"),
    ("VERARGUES-ENTRE-VIGNES", "ENTRE-VIGNES"),
    ("SAINT-JEAN-DU-MINERVOIS", "SAINT-JEAN-DE-MINERVOIS"),
    ("SAINT-JULIEN-D-ORLARGUES", "SAINT-JULIEN"),
]
# Exact-match overrides.
COMMUNE_OVERRIDES = [
    ("VACQUERIE-ET-ST-MARTIN-DE-CASTRIES", "LA-VACQUERIE-ET-SAINT-MARTIN-DE-CASTRIES"),
    ("VALRAS", "VALRAS-PLAGE"),
    ("SALVETAT-SUR-AGOUT", "LA-SALVETAT-SUR-AGOUT"),
]


def canonical_commune(c: Column, name_rules=COMMUNE_NAME_RULES, overrides=COMMUNE_OVERRIDES) -> Column:
    """Spaces → dashes, upper case, separator repair, ordered literal replacements, then exact overrides."""
    out = F.upper(F.replace(c, F.lit(" "), F.lit("-")))
    for src, dst in COMMUNE_CHAR_RULES:
        out = F.replace(out, F.lit(src), F.lit(dst))
    for src, dst in name_rules:
        out = F.replace(out, F.lit(src), F.lit(dst))
    expr = out
    for src, dst in overrides:
        expr = F.when(out == src, F.lit(dst)).otherwise(expr)
    return expr


def upper_dash(c: Column) -> Column:
    """Upper case with spaces as dashes (commune join key of the report log)."""
    return F.replace(F.upper(c), F.lit(" "), F.lit("-"))
