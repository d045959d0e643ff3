"""Slide flags, deck rollup and quality tiers."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from deckmill import fixed_values as fv
from deckmill.config import QualityRules
from deckmill.functions import text as tx


@dataclass(frozen=True)
class SlideMarkers:
    """Substrings of lower-cased slide XML that raise a flag.

    ``table`` is used only where no parsed ``has_table`` column exists.
    """

    chart: Sequence[str] = ("chart",)
    diagram: Sequence[str] = ("dgm", "diagram")
    image: Sequence[str] = ("blipfill", "<p:pic")
    shape: str = r"<p:sp[> ]"
    table: Sequence[str] = ("<a:tbl",)


def slide_flags(slides: DataFrame, xml: str = "xml", text_length: str = "text_length",
                has_table: str | None = "has_table", parsed: str | None = "parsed",
                markers: SlideMarkers = SlideMarkers(), rules: QualityRules = QualityRules()) -> DataFrame:
    """Flags and derived flags per slide. An unparsable slide has none."""
    staged = slides.withColumn("__low", F.lower(xml))
    low = F.col("__low")
    ok = F.col(parsed) if parsed else F.lit(True)
    table = F.col(has_table) if has_table else tx.contains_any(low, markers.table)
    flagged = staged.withColumns({
        "has_chart": ok & tx.contains_any(low, markers.chart),
        "has_table": ok & table,
        "has_diagram": ok & tx.contains_any(low, markers.diagram),
        "has_smartart": F.lit(False),
        "has_image": ok & tx.contains_any(low, markers.image),
        "shape_count": F.when(ok, F.regexp_count(low, F.lit(markers.shape))).otherwise(F.lit(0)),
        "text_length": F.when(ok, F.col(text_length)).otherwise(F.lit(0)),
    }).drop("__low")
    analytical = F.col("has_chart") | F.col("has_table") | F.col("has_diagram") | F.col("has_smartart")
    derived = flagged.withColumn("is_analytical", analytical)
    return derived.withColumns({
        "is_text_heavy": (F.col("text_length") > rules.text_heavy_chars) & ~F.col("is_analytical"),
        "is_photo_heavy": F.col("has_image") & ~F.col("is_analytical")
        & (F.col("text_length") < rules.photo_heavy_chars),
    })


def keyword_mask(lowered: Column, keywords: Sequence[str]) -> Column:
    """One bit per keyword, so that distinct hits of many slides combine by OR."""
    words = sorted(set(keywords))
    if len(words) > 62 or any(" " in w for w in words):
        raise ValueError("a mask takes up to 62 keywords without blanks")
    mask = F.lit(0).cast("bigint")
    for i, word in enumerate(words):
        mask = mask + F.when(lowered.contains(word), 1 << i).otherwise(0).cast("bigint")
    return mask


def deck_rollup(flagged: DataFrame, keys: Sequence[str], text: str = "text",
                keywords: Sequence[str] = tuple(fv.REASONING_KEYWORDS),
                rules: QualityRules = QualityRules()) -> DataFrame:
    """Slides to decks in one aggregation that combines before the shuffle.

    Keywords hold no blanks, so a keyword occurs in the blank-joined text of a
    deck exactly when it occurs in one of its slides.
    """
    def n(flag: Column) -> Column:
        return F.count_if(flag).cast("int")
    masked = flagged.withColumn("__low", F.lower(text)).withColumn("__mask", keyword_mask(F.col("__low"), keywords))
    rolled = masked.groupBy(*keys).agg(
        F.count("*").cast("int").alias("slide_count"),
        n(F.col("is_analytical")).alias("analytical_slides"),
        n(F.col("has_chart")).alias("slides_with_chart"),
        n(F.col("has_table")).alias("table_slides"),
        n(F.col("has_diagram") | F.col("has_smartart")).alias("diagram_slides"),
        n(F.col("is_text_heavy")).alias("text_heavy_slides"),
        n(F.col("is_photo_heavy")).alias("photo_heavy_slides"),
        F.bit_or("__mask").alias("__mask"))
    def share(c: str) -> Column:
        return F.col(c) / F.col("slide_count")
    return rolled.withColumns({
        "analytical_pct": share("analytical_slides"),
        "text_heavy_pct": share("text_heavy_slides"),
        "photo_heavy_pct": share("photo_heavy_slides"),
        "reasoning_score": F.least(F.lit(1.0), F.bit_count("__mask") / F.lit(rules.reasoning_full_hits)),
    }).drop("__mask")


def with_tier(decks: DataFrame, chart_files: str | None = None, rules: QualityRules = QualityRules(),
              name: str = "quality_classification") -> DataFrame:
    """Tier rules. ``chart_files`` counts the chart members of the container."""
    extra = F.coalesce(F.col(chart_files), F.lit(0)) if chart_files else F.lit(0)
    charts = (F.col("slides_with_chart") + extra).cast("int")
    cd = F.greatest(charts, extra) + F.col("diagram_slides")
    ana = F.col("analytical_pct")
    tier = (F.when(F.coalesce(F.col("slide_count"), F.lit(0)) == 0, "LOW")
            .when(F.col("text_heavy_pct") >= rules.text_heavy_reject, "LOW")
            .when(F.col("photo_heavy_pct") >= rules.photo_heavy_reject, "LOW")
            .when((ana >= rules.high_analytical) & (cd >= rules.high_min_charts), "HIGH")
            .when((ana >= rules.medium_analytical) & (cd >= rules.medium_min_charts), "MEDIUM")
            .when((ana >= rules.some_analytical) & (cd >= 1), "MEDIUM")
            .otherwise("LOW"))
    return decks.withColumn("chart_slides", charts).withColumn(name, tier)


def legacy_tier(size: Column, rules: QualityRules = QualityRules()) -> Column:
    """Old binary format, judged by size."""
    return F.when(size > rules.legacy_medium_bytes, "MEDIUM").otherwise("LOW")


def summary_line(tier: str = "quality_classification") -> Column:
    """Human-readable quality line used in rejection reasons."""
    def s(c: str) -> Column:
        return F.col(c).cast("string")
    pct = F.bround(F.col("analytical_pct") * 100, 0).cast("int").cast("string")
    return F.concat(F.col(tier), F.lit(": "), s("analytical_slides"), F.lit("/"), s("slide_count"),
                    F.lit(" analytical ("), pct, F.lit("%), "), s("chart_slides"), F.lit(" charts, "),
                    s("table_slides"), F.lit(" tables, "), s("diagram_slides"), F.lit(" diagrams"))


def delivery_share(charts: Column, tables: Column, slides: Column) -> Column:
    return (charts + tables) / F.greatest(slides, F.lit(1)) * F.lit(100)


def delivery_tier(charts: Column, tables: Column, slides: Column, extension: Column | None = None) -> Column:
    """Tier by drawn charts and tables; the old format is UNKNOWN."""
    share = delivery_share(charts, tables, slides)
    drawn = charts + tables
    tier = (F.when((share >= 50) & (drawn >= 3), "HIGH")
            .when((share >= 40) | (drawn >= 1), "MEDIUM").otherwise("LOW"))
    return F.when(F.lower(extension) == ".ppt", "UNKNOWN").otherwise(tier) if extension is not None else tier


def rollup_parts(decks: DataFrame, parts: str = "parts", keywords: Sequence[str] = tuple(fv.REASONING_KEYWORDS),
                 markers: SlideMarkers = SlideMarkers(), rules: QualityRules = QualityRules()) -> DataFrame:
    """The rollup where a deck row carries its slides: no shuffle, the row is the group."""
    chosen = F.filter(parts, lambda p: p["is_slide"])
    lowered = F.transform(chosen, lambda p: F.struct(
        F.lower(p["xml"]).alias("low"), F.lower(p["text"]).alias("text"), p["parsed"].alias("ok"),
        F.when(p["parsed"], p["text_length"]).otherwise(F.lit(0)).alias("n"), p["has_table"].alias("table")))
    signs = F.transform("__low", lambda p: F.struct(
        (p["ok"] & tx.contains_any(p["low"], markers.chart)).alias("chart"), (p["ok"] & p["table"]).alias("table"),
        (p["ok"] & tx.contains_any(p["low"], markers.diagram)).alias("diagram"),
        (p["ok"] & tx.contains_any(p["low"], markers.image)).alias("image"), p["n"].alias("n"),
        keyword_mask(p["text"], keywords).alias("mask")))

    def n(test) -> Column:
        return F.size(F.filter("__signs", test))

    def analytical(s: Column) -> Column:
        return s["chart"] | s["table"] | s["diagram"]
    counted = decks.withColumn("__low", lowered).withColumn("__signs", signs).withColumns({
        "slide_count": F.size("__signs"),
        "analytical_slides": n(analytical),
        "slides_with_chart": n(lambda s: s["chart"]),
        "table_slides": n(lambda s: s["table"]),
        "diagram_slides": n(lambda s: s["diagram"]),
        "text_heavy_slides": n(lambda s: (s["n"] > rules.text_heavy_chars) & ~analytical(s)),
        "photo_heavy_slides": n(lambda s: s["image"] & ~analytical(s) & (s["n"] < rules.photo_heavy_chars)),
        "__mask": F.aggregate("__signs", F.lit(0).cast("bigint"), lambda acc, s: acc.bitwiseOR(s["mask"])),
    })

    def share(c: str) -> Column:
        return F.when(F.col("slide_count") > 0, F.col(c) / F.col("slide_count")).otherwise(F.lit(0.0))
    return counted.withColumns({
        "analytical_pct": share("analytical_slides"), "text_heavy_pct": share("text_heavy_slides"),
        "photo_heavy_pct": share("photo_heavy_slides"),
        "reasoning_score": F.least(F.lit(1.0), F.bit_count("__mask") / F.lit(rules.reasoning_full_hits)),
    }).drop("__low", "__signs", "__mask")
