"""Record, file and container rules, each with the first failing reason."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from deckmill import fixed_values as fv
from deckmill.config import DeliveryRules, IntegrityRules, SizeFloors
from deckmill.functions import content as ct
from deckmill.functions import names
from deckmill.functions import text as tx
from deckmill.functions import urls
from deckmill.operators import scale


def is_deck_record(mime: Column, detected: Column, url: Column,
                   mimes: Sequence[str] = tuple(fv.DECK_MIMES),
                   suffixes: Sequence[str] = tuple(fv.SHOW_SUFFIXES)) -> Column:
    """Declared or detected MIME type, or the URL suffix, says deck."""
    def low(c: Column) -> Column:
        return F.lower(F.coalesce(c, F.lit("")))
    return low(mime).isin(list(mimes)) | low(detected).isin(list(mimes)) | urls.ends_with_deck_suffix(low(url), suffixes)


def is_deck_resource(url: Column, declared: Column, suffixes: Sequence[str] = tuple(fv.DECK_SUFFIXES),
                     formats: Sequence[str] = ("PPT", "PPTX")) -> Column:
    """Catalogue resource with a deck path or a declared deck format."""
    return (F.lower(names.suffix(urls.path_name(url))).isin(list(suffixes))
            | F.upper(tx.strip(F.coalesce(declared, F.lit("")))).isin(list(formats)))


def declared_size_ok(length: Column, floor: int) -> Column:
    """Reject only a known size below the floor; zero or unreadable means unknown."""
    size = F.coalesce(length.try_cast("bigint"), F.lit(0))
    return ~((size > 0) & (size < floor))


def is_complete(*columns: Column) -> Column:
    """All fields hold something: no null, no empty text, no zero."""
    test = F.lit(True)
    for c in columns:
        test = test & ~F.coalesce(c.cast("string"), F.lit("")).isin("", "0")
    return test


def size_ok(size: Column, floor: int = SizeFloors().default) -> Column:
    return size >= floor


def content_type_admissible(header: Column, final_url: Column, original_url: Column) -> Column:
    """Deck MIME type, or a binary or missing type together with a deck suffix."""
    low = F.lower(F.coalesce(header, F.lit("")))
    deck = F.lit(False)
    for mime in fv.DECK_MIMES:
        deck = deck | F.contains(low, F.lit(mime))
    binary = F.contains(low, F.lit("octet-stream")) | F.contains(low, F.lit("binary")) | (low == "")
    suffix = (urls.ends_with_deck_suffix(final_url, fv.DECK_SUFFIXES)
              | urls.ends_with_deck_suffix(original_url, fv.DECK_SUFFIXES))
    return deck | (binary & suffix)


def content_type_expected(header: Column) -> Column:
    """Softer rule of the API harvesters, which only note a surprise."""
    low = F.lower(F.coalesce(header, F.lit("")))
    known = F.lit(False)
    for mime in fv.ADMISSIBLE_CONTENT_TYPES:
        known = known | F.contains(low, F.lit(mime))
    return (low == "") | known | F.contains(low, F.lit("stream"))


def validate(df: DataFrame, rules: IntegrityRules = IntegrityRules(), *, exists: Column | None = None,
             size: str = "file_size", file_hash: str = "file_hash", html: str = "is_html",
             extension: str = "extension", container_reason: str = "container_reason",
             slides: str = "slide_count", name: str = "validation") -> DataFrame:
    """Integrity chain. The result struct carries the first failure only.

    ``container_reason`` is empty for a sound container. Later facts stay at
    their defaults once a step fails, as nothing after it is looked at.
    """
    ext = F.lower(F.col(extension))
    here = exists if exists is not None else F.lit(True)
    reason = F.when(~here, F.lit("File does not exist"))
    reason = reason.when(F.col(size) < rules.min_bytes, F.concat(
        F.lit("Below min size ("), F.col(size).cast("string"), F.lit(f" < {rules.min_bytes}B)")))
    reason = reason.when(F.col(html), F.lit("HTML content detected (likely error page)"))
    reason = reason.when(~ext.isin(fv.DECK_SUFFIXES), F.concat(F.lit("Unsupported format: "), ext))
    reason = reason.when(F.col(container_reason) != "", F.col(container_reason))
    reason = reason.when(F.col(slides) < rules.min_slides, F.concat(
        F.lit("Insufficient slides ("), F.col(slides).cast("string"), F.lit(f" < {rules.min_slides})")))
    if rules.max_slides:
        reason = reason.when(F.col(slides) > rules.max_slides, F.concat(
            F.lit("Exceeds max slides ("), F.col(slides).cast("string"), F.lit(f" > {rules.max_slides})")))
    staged = df.withColumn("__reason", F.coalesce(reason, F.lit("")))
    r = F.col("__reason")
    size_failed = F.startswith(r, F.lit("Below min size"))
    slides_failed = F.startswith(r, F.lit("Insufficient slides")) | F.startswith(r, F.lit("Exceeds max slides"))
    missing = r == "File does not exist"
    format_failed = (r != "") & ~missing & ~size_failed & ~slides_failed
    return staged.withColumn(name, F.struct(
        (r == "").alias("is_valid"),
        F.when(missing, F.lit(0)).otherwise(F.col(size)).cast("bigint").alias("file_size"),
        F.when((r == "") | slides_failed, F.col(slides)).otherwise(F.lit(0)).cast("int").alias("slide_count"),
        F.when(missing | size_failed, F.lit("")).otherwise(F.col(file_hash)).alias("file_hash"),
        (~format_failed).alias("integrity_ok"),
        (~size_failed).alias("size_ok"),
        (~slides_failed).alias("slide_count_ok"),
        (~format_failed).alias("format_ok"),
        r.alias("rejection_reason"))).drop("__reason")


def clean_chain(df: DataFrame, *, floor: int, name: str = "name", size: str = "file_size",
                corruption: str = "corruption_reason", digest: str = "file_hash") -> DataFrame:
    """Quarantine reasons: size, then corruption, then duplicate of the lowest name.

    Files without a hash are neither kept as originals nor quarantined.
    """
    early = F.when(F.col(size) < floor, F.concat(
        F.lit("Below size threshold ("), F.col(size).cast("string"), F.lit(" bytes)")))
    early = early.when(F.coalesce(F.col(corruption), F.lit("")) != "", F.col(corruption))
    staged = df.withColumn("__early", early).withColumn(
        "__key", F.when(F.col("__early").isNull(), F.nullif(F.col(digest), F.lit(""))))
    keepers = (staged.where(F.col("__key").isNotNull()).groupBy("__key")
               .agg(F.min(name).alias("__keeper"), F.count("*").alias("__n")).where(F.col("__n") > 1))
    marked = scale.attach(staged, keepers, ["__key"], "__n", [name])
    duplicate = F.when(F.col("__keeper").isNotNull() & (F.col(name) != F.col("__keeper")),
                       F.concat(F.lit("Duplicate of "), F.col("__keeper")))
    return (marked.withColumn("quarantine_reason", F.coalesce("__early", duplicate))
            .drop("__early", "__key", "__keeper", "__n"))


def template_funnel(df: DataFrame, seen_tags: DataFrame, *, floor: int = SizeFloors().bulk,
                    name: str = "name", size: str = "file_size", magic_ok: str = "magic_ok",
                    tag: str = "tag", parts: str = "slides",
                    china_names: Sequence[str] = tuple(fv.CHINA_NAME_KEYWORDS),
                    usa_names: Sequence[str] = tuple(fv.USA_NAME_KEYWORDS),
                    cjk_pattern: str = fv.CJK_PATTERN, terms: Sequence[str] = tuple(fv.US_CONTENT_TERMS)) -> DataFrame:
    """Filter funnel of the template set; null reason means kept. The slides are dropped."""
    from deckmill.operators import ledger, screens

    # The slide text is judged in its own row, so that only short columns are shuffled.
    early = df.withColumn("__early", _name_reasons(name, size, magic_ok, floor, china_names, usa_names))
    late = (F.when(screens.cjk_dense(F.col(parts), pattern=cjk_pattern, first_only=True), "china_content")
            .when(screens.topically_dense(F.col(parts), terms), "usa_content"))
    judged = early.withColumn("__late", F.when(F.col("__early").isNull(), late)).drop(parts)
    flagged = ledger.flag_seen(judged, seen_tags.select(F.col("tag").alias(tag)), [tag], [name], "__seen")
    reason = F.coalesce("__early", F.when(F.col("__seen"), "duplicate"), "__late")
    return flagged.withColumn("reason", reason).drop("__seen", "__early", "__late")


def _name_reasons(name: str, size: str, magic: str, floor: int, china_names: Sequence[str], usa_names: Sequence[str]) -> Column:
    low = F.lower(F.col(name))
    return (F.when(F.col(size).isNull(), "invalid").when(F.col(size) < floor, "too_small").when(~F.col(magic), "invalid")
            .when(tx.contains_any(low, china_names), "china_filename").when(tx.contains_any(low, usa_names), "usa_filename"))


def content_funnel(df: DataFrame, *, floor: int = SizeFloors().bulk, name: str = "name", size: str = "file_size",
                   magic_ok: str = "magic_ok", tag: str = "tag", parts: str = "slides", order: Sequence[str] = ("path",),
                   china_names: Sequence[str] = tuple(fv.CHINA_STRONG_NAME_KEYWORDS),
                   usa_names: Sequence[str] = tuple(fv.USA_STRONG_NAME_KEYWORDS), cjk_pattern: str = fv.CJK_PATTERN) -> DataFrame:
    """Notebook funnel: duplicates by content within the run, looked for before the slide text."""
    from deckmill.operators import dedup, screens

    early = df.withColumn("__early", _name_reasons(name, size, magic_ok, floor, china_names, usa_names))
    late = F.when(screens.cjk_dense(F.col(parts), pattern=cjk_pattern, first_only=True), "china_content")
    judged = early.withColumn("__late", F.when(F.col("__early").isNull(), late)).drop(parts)
    keyed = judged.withColumn("__key", F.when(F.col("__early").isNull(), F.col(tag)))
    marked = dedup.mark_copies(keyed, ["__key"], list(order), list(order), "__keeper", "__copy")
    reason = F.coalesce("__early", F.when(F.col("__copy"), "duplicate"), "__late")
    return marked.withColumn("reason", reason).drop("__early", "__late", "__key", "__keeper", "__copy")


def accept_unparsed(df: DataFrame, rules: DeliveryRules = DeliveryRules(), *, error: str = "parse_error",
                    size: str = "file_size", slides: str = "slide_count", quality: str = "quality") -> DataFrame:
    """A large file that cannot be parsed counts as an unknown deck of minimum length."""
    big = (F.col(error) != "") & (F.col(size) >= rules.unparsed_accept_bytes)
    return df.withColumns({
        slides: F.when(big, F.lit(rules.min_slides)).otherwise(F.col(slides)),
        quality: F.when(big, F.lit("UNKNOWN")).otherwise(F.col(quality)),
        error: F.when(big, F.lit("")).otherwise(F.col(error)),
    })


def transfer_reason(error: Column, slides: Column, organization: Column, author: Column,
                    blocked: Sequence[str], rules: DeliveryRules = DeliveryRules()) -> Column:
    """Why a file is not transferred; PASS otherwise."""
    org = F.lower(F.coalesce(F.nullif(organization, F.lit("")), author, F.lit("")))
    return (F.when(error != "", F.concat(F.lit("corrupt file — "), error))
            .when(slides < rules.min_slides, F.concat(F.lit("only "), slides.cast("string"),
                                                      F.lit(f" slides (min {rules.min_slides})")))
            .when((org != "") & tx.contains_any(org, blocked), F.concat(F.lit("blocked organisation: "), org))
            .otherwise(F.lit("PASS")))


def magic_ok(content: Column) -> Column:
    return F.coalesce(ct.has_deck_magic(content), F.lit(False))
