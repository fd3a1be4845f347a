"""Scores of theme drafts, their gates and the mapping to a relational store."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import rules
from .text import reasons


def importance(s: Column) -> Column:
    """Weighted mean of D1, D2, D3 (0.4, 0.4, 0.2), rounded; float noise is taken out first."""
    return F.round(F.round(s["D1"] * 0.40 + s["D2"] * 0.40 + s["D3"] * 0.20, 6)).cast("int")


def action_class(s: Column) -> Column:
    """A to D from urgency (D4) and hands-on work (D5), one step up for D6 >= 4 and down for D6 <= 2."""
    base = F.when(s["D4"] >= 4, F.when(s["D5"] >= 4, 0).otherwise(1)).otherwise(F.when(s["D5"] >= 4, 2).otherwise(3))
    step = F.when(s["D6"] >= 4, -1).when(s["D6"] <= 2, 1).otherwise(0)
    return F.element_at(F.array(*[F.lit(x) for x in "ABCD"]), (F.greatest(F.lit(0), F.least(F.lit(3), base + step)) + 1).cast("int"))


def gate_deep(importance_value: Column, level: Column) -> Column:
    return (importance_value >= 3) | F.coalesce(level.isin("国家", "省"), F.lit(False))


def value_tags(importance_value: Column, themes: Column, compliance=rules.COMPLIANCE_THEMES, opportunity=rules.OPPORTUNITY_THEMES, moat=rules.MOAT_THEMES) -> Column:
    """Compliance, opportunity and moat tags in this order; a trend tag when there is none."""
    t = F.coalesce(themes, F.array().cast("array<string>"))
    has = lambda names: F.arrays_overlap(t, F.array(*[F.lit(n) for n in names]))
    tags = reasons((has(compliance), "合规"), (has(opportunity), "机会"), (has(moat) & (importance_value >= 3), "壁垒"))
    return F.when(F.size(tags) == 0, F.array(F.lit("趋势"))).otherwise(tags)


def canonical_themes(ids: Column, known: Iterable[str]) -> Column:
    """Known ids stay, an unknown <id>_theme becomes a known <id>, other ids stay; empty ones and repeats go."""
    ok = F.array(*[F.lit(k) for k in known])
    base = lambda x: F.regexp_replace(x, "_theme$", "")
    one = lambda x: F.when(F.array_contains(ok, x), x).when(x.endswith("_theme") & F.array_contains(ok, base(x)), base(x)).otherwise(x)
    return F.array_distinct(F.transform(F.filter(F.coalesce(ids, F.array().cast("array<string>")), lambda x: x.isNotNull() & (x != "")), one))


def correct_evidence(themes: Column, primary: Column, head: Column, needed: dict[str, Iterable[str]], forced: tuple[str, Iterable[str]] | None = None) -> Column:
    """STRUCT<themes, primary_theme>: themes without one of their evidence words in the body's head go; the primary theme falls back to
    the first that is left, or is forced where the build-out words stand (B29)."""
    out = themes
    for theme, words in needed.items():
        hit = F.lit(False)
        for w in words:
            hit = hit | head.contains(w)
        out = F.when(F.coalesce(hit, F.lit(False)), out).otherwise(F.array_remove(out, theme))
    first = F.when(F.array_contains(out, primary), primary).otherwise(F.coalesce(F.try_element_at(out, F.lit(1)), F.lit("")))
    if forced:
        theme, words = forced
        hit = F.lit(False)
        for w in words:
            hit = hit | head.contains(w)
        first = F.when(F.coalesce(hit, F.lit(False)) & F.array_contains(out, theme), F.lit(theme)).otherwise(first)
    return F.struct(out.alias("themes"), first.alias("primary_theme"))


def check_draft(d: dict[str, Column], known: Iterable[str], impact_keys: Iterable[str], level: Column) -> Column:
    """Reasons against a draft: primary theme, unknown ids, importance and action that don't follow from the scores, impact keys, deep flag."""
    known_array = F.array(*[F.lit(k) for k in known])
    imp = importance(d["scores"])
    return reasons(
        (~F.array_contains(d["themes"], d["primary_theme"]), "primary_not_in_themes"),
        (F.size(F.array_except(d["themes"], known_array)) > 0, "unknown_theme"),
        (d["importance"] != imp, "importance_mismatch"),
        (d["action_class"] != action_class(d["scores"]), "action_class_mismatch"),
        (F.array_sort(F.map_keys(d["impact"])) != F.array_sort(F.array(*[F.lit(k) for k in impact_keys])), "impact_keys"),
        (d["gate_passed_deep"] != gate_deep(imp, level), "deep_flag"),
    )


def importance_enum(score: Column) -> Column:
    """5 and more strategic, 4 major, 3 general, else info."""
    return F.when(score >= 5, "STRATEGIC").when(score == 4, "MAJOR").when(score == 3, "GENERAL").otherwise("INFO")


def summary_reasons(one_line: Column, what: Column, why: Column, limits: tuple[int, int, int] = (400, 25, 25)) -> Column:
    """Reasons against a summary row: empty or too long fields."""
    out = []
    for name, c, n in zip(("summary", "what", "why"), (one_line, what, why), limits):
        t = F.trim(F.coalesce(c, F.lit("")))
        out += [(t == "", f"{name}_empty"), (F.length(t) > n, f"{name}_too_long")]
    return reasons(*out)
