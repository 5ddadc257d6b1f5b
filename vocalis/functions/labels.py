"""Column expressions for corpus tags and emotion codes (all JVM-side)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import vocab


def _q(v: str) -> str:
    return "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"


def corpus_tag_sql(path: str) -> str:
    """P2 as SQL text: first matching case-sensitive substring, else null."""
    whens = " ".join(f"WHEN contains({path}, {_q(needle)}) THEN {_q(name)}" for needle, name in vocab.CORPUS_TAGS)
    return f"CASE {whens} END"


def emotion_code_sql(path: str, corpus: str) -> str:
    """P3 as SQL text: regex per corpus on the whole path; '' when no match."""
    whens = " ".join(f"WHEN {corpus} = {_q(name)} THEN regexp_extract({path}, {_q(pat)}, {grp})"
                     for name, (pat, grp) in vocab.CODE_PATTERNS.items())
    return f"CASE {whens} END"


def basename(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def _map_lit(d: dict) -> Column:
    return F.create_map(*[F.lit(x) for kv in d.items() for x in kv])


def filename_label(path: Column) -> Column:
    """Label from the lower-cased basename only, 8-label vocabulary.

    Ordered rules: RAVDESS dash form; TESS three-part word; CREMA code;
    SAVEE letters; else unknown. ``get`` returns null when a part is absent
    (plain indexing raises under ANSI).
    """
    fn = F.lower(basename(path))
    stem = F.replace(fn, F.lit(".wav"), F.lit(""))
    dash = F.split(stem, "-")
    n_dash = F.length(fn) - F.length(F.replace(fn, F.lit("-"), F.lit("")))
    rav_form = fn.startswith(vocab.FN_RAVDESS_PREFIX) | (n_dash >= vocab.FN_RAVDESS_MIN_DASHES)
    us = F.split(stem, "_")
    has_us = fn.contains("_")
    third = F.get(us, 2)
    last_letters = F.regexp_replace(F.element_at(us, -1), r"[^\p{L}]", "")
    unknown = F.lit(vocab.UNKNOWN)
    return (
        F.when(rav_form & (F.size(dash) >= 3),
               F.coalesce(F.try_element_at(_map_lit(vocab.FN_RAVDESS), F.get(dash, 2)), unknown))
        .when(has_us & (F.size(us) == 3) & third.isin(vocab.FN_TESS_WORDS), third)
        .when(has_us & (F.size(us) >= 3),
              F.coalesce(F.try_element_at(_map_lit(vocab.FN_CREMA), F.upper(third)), unknown))
        .when(has_us,
              F.coalesce(F.try_element_at(_map_lit(vocab.FN_SAVEE), last_letters), unknown))
        .otherwise(unknown)
    )


def title_case(c: Column) -> Column:
    """First letter of every run of letters upper, the others lower case (a
    run also starts after a digit or a sign, which ``initcap`` doesn't see)."""
    apart = F.regexp_replace(c, "(?<=[^\\p{L}\\s])(?=\\p{L})", "\u0001 ")
    return F.replace(F.initcap(apart), F.lit("\u0001 "), F.lit(""))
