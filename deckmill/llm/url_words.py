"""URL filter: host names split into words by Viterbi over word frequencies, then naive Bayes on the words.

Rules come first: the longest rule whose host is the URL's host or a parent of it and whose path starts the URL's path.
Where none fits, the host's labels and the path are split into words: each run of letters is cut where the product of
unigram probabilities is greatest (unknown pieces pay for each letter). A multinomial naive Bayes scores these words; the
verdict is block where the log odds pass ``odds``.

The classifier learns from the URLs that a rule judges, with the rule's verdict as label, and from a small table of names.
A word counts once for each host it stands with, so that one large site says no more than a small one. Nothing is learnt
from the parts that rules look at (as many of the last labels and first path segments as the longest rule names), as the
labels were made from them. The prior is a parameter, because the rules cover no fair share of the web: by default a URL is
blocked on evidence only.

Frequencies are counted over the text, hosts and paths of all pages. Words of up to 24 letters that occur 3 times or more
are kept; where these are more than ``most_words``, those above a count that a histogram of the counts gives. Only kept
words reach the driver and the tasks; other pieces say nothing.

Edge cases: a null URL, or one without ``://``, has an empty host and path and is allowed (no word speaks against it);
rows that repeat are judged alike and learnt once; null texts are empty; without pages, or where no rule fits, only the
labelled names are known.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from deckmill.llm.common import by_value, map_arrow, stored

# fixed values: the labelled names
BLOCKED_NAMES = """adult-video ad-server banner-ads bet-win bets-online bingo-win bonus-casino cash-loan
casino-online cheap-replica click-track coupon-spam crack-serial dating-hot escort-x fake-watches
fast-cash free-casino free-coins free-pills free-prize gamble-win hack-tool hot-dating hot-girls jackpot-slots
keygen-crack link-farm loan-cash lottery-prize malware-download nude-girls online-casino payday-loan pharma-pills
phishing-login pills-shop poker-bonus popup-ads porn-video prize-win replica-watches seo-links sex-chat slots-jackpot
spam-mail spyware-tool torrent-crack track-pixel viagra-cheap virus-free-download warez-crack win-money xxx-video""".split()
ALLOWED_NAMES = """academy-press archive-library art-museum biology-notes book-review botany-garden bridge-school city-council
civil-engineering climate-data college-physics community-health concert-hall cooking-recipes daily-news design-studio
digital-library economics-review education-center energy-research family-doctor farm-market film-festival forest-service
garden-club geography-maps government-office grammar-guide green-energy health-ministry history-museum home-repair
hospital-care journal-science language-school law-library local-weather math-teacher medical-journal music-school nature-park
network-institute news-today open-data park-service philosophy-reader photo-gallery poetry-house public-health radio-station
research-group river-bridge science-museum software-guide space-agency sports-club student-union teacher-training
technical-university theatre-company tourism-office town-hall travel-guide university-press water-works weather-service
wild-life wiki-project writing-center""".split()
LABELLED = [(name, "block") for name in BLOCKED_NAMES] + [(name, "allow") for name in ALLOWED_NAMES]
RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]
LONGEST_WORD = 24
SMALLEST_COUNT = 3
RUN = re.compile(r"[^\W\d_]+")
TAGS = re.compile(r"<[^<>]*>")


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host with A-Z in lower case, and path, both empty where the URL is null or has no ``://``."""
    rest = F.when(F.instr(url, "://") > 0, F.substr(url, F.instr(url, "://") + F.lit(3)))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> Column:
    """Struct (rule, verdict) of the longest rule that fits; among rules of one length the first by code point."""
    ordered = sorted(rules, key=lambda r: (-len(r[0] + r[1]), r[0] + r[1]))
    out = None
    for name, start, verdict in ordered:
        fits = ((host == name) | F.endswith(host, F.lit(f".{name}"))) & F.startswith(path, F.lit(start))
        found = F.struct(F.lit(name + start).alias("rule"), F.lit(verdict).alias("verdict"))
        out = F.when(fits, found) if out is None else out.when(fits, found)
    return out if out is not None else F.lit(None).cast("struct<rule:string,verdict:string>")


@dataclass
class Words:
    """Log probabilities of words; a run of letters that is no word costs ``unknown`` and ``letter`` for each letter."""
    logs: dict
    unknown: float
    letter: float

    def split(self, run: str) -> list[str]:
        """The likeliest words of one run of letters."""
        best, cut = [0.0], [0]
        for end in range(1, len(run) + 1):
            choices = []
            for start in range(max(0, end - LONGEST_WORD), end):
                log = self.logs.get(run[start:end])
                choices.append((best[start] + (self.unknown + self.letter * (end - start) if log is None else log), start))
            score, start = max(choices)
            best.append(score)
            cut.append(start)
        out, end = [], len(run)
        while end:
            out.append(run[cut[end]:end])
            end = cut[end]
        return out[::-1]


def word_frequencies(pages: DataFrame, most_words: int = 50_000, text_column: str = "html", url_column: str = "url") -> dict[str, int]:
    """The most frequent words of the text and the URLs of all pages; each task adds up its own before the shuffle."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for html, host, path in zip(*(column.to_pylist() for column in batch.columns)):
                counts.update(w for part in (TAGS.sub(" ", html), host, path) for w in RUN.findall(part.lower()) if len(w) <= LONGEST_WORD)
            if len(counts) > 500_000:
                yield pa.RecordBatch.from_arrays([pa.array(list(counts)), pa.array(list(counts.values()), pa.int64())], ["word", "n"])
                counts.clear()
        yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], ["word", "n"])

    host, path = host_and_path(pages[url_column])
    found = map_arrow(pages.select(F.coalesce(pages[text_column], F.lit("")).alias("html"), host.alias("host"), path.alias("path")), run, "word string, n long")
    counted = stored(found.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= SMALLEST_COUNT), "url-words")
    level = F.floor(F.log2("n") * 8).cast("int")
    taken, least = 0, None
    for row in sorted(counted.groupBy(level.alias("level")).count().collect(), reverse=True):  # at most 8 levels a bit
        taken += row["count"]
        if taken > most_words:
            break
        least = row["level"]
    kept = counted.where(level >= F.lit(least) if least is not None else F.lit(False)).toPandas()
    return dict(zip(kept["word"], kept["n"].astype(int)))


def word_model(counts: dict[str, int], labelled: Sequence[tuple[str, str]]) -> Words:
    """Frequencies with the labelled names' words as frequent as the mean of their rank, so that they split off."""
    known = dict(counts)
    floor = max(50, sum(counts.values()) // 20_000)
    for name, _ in labelled:
        for word in RUN.findall(name.lower()):
            known[word] = max(known.get(word, 0), floor)
    total = sum(known.values())
    logs = {w: math.log(n / total) - (4.0 if len(w) < 3 else 0.0) for w, n in known.items()}
    return Words(logs, -math.log(total), -1.5)


@dataclass
class Bayes:
    """Log odds of block against allow: prior, and per word."""
    words: Words
    prior: float
    odds: dict

    def tokens(self, host: str, path: str) -> list[str]:
        return [w for run in RUN.findall(f"{host} {path}".lower()) for w in self.words.split(run)]

    def score(self, host: str, path: str) -> float:
        return self.prior + sum(self.odds.get(t, 0.0) for t in self.tokens(host, path))


def unseen_by_rules(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> tuple[Column, Column]:
    """Host and path without as many last labels and first segments as the longest rule names."""
    labels = max((name.count(".") + 1 for name, _, _ in rules), default=0)
    segments = max((len([part for part in start.split("/") if part]) for _, start, _ in rules), default=0)
    return F.regexp_replace(host, rf"(^|\.)[^.]*(\.[^.]*){{0,{labels - 1}}}$" if labels else r"$^", ""), F.regexp_replace(path, rf"^(/[^/]*){{0,{segments}}}", "")


def ruled_words(pages: DataFrame, words: Words, rules: Sequence[tuple[str, str, str]] = RULES, url_column: str = "url") -> dict[str, tuple[int, int]]:
    """For each known word, the number of hosts that it stands with in blocked and in allowed URLs, as the rules judge them."""
    model = Bayes(words, 0.0, {})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen = set()
            for host, labels, path, verdict in zip(*(column.to_pylist() for column in batch.columns)):
                seen.update((w, host, verdict) for w in model.tokens(labels, path) if w in words.logs)
            rows = list(zip(*seen)) or [(), (), ()]
            yield pa.RecordBatch.from_arrays([pa.array(list(column), pa.string()) for column in rows], ["word", "host", "verdict"])

    host, path = host_and_path(pages[url_column])
    parts = pages.select(host.alias("host"), path.alias("path"))
    labels, segments = unseen_by_rules(F.col("host"), F.col("path"), rules)
    ruled = parts.select("host", labels.alias("labels"), segments.alias("path"), rule_of(F.col("host"), F.col("path"), rules)["verdict"].alias("verdict"))
    per_host = map_arrow(ruled.where(F.col("verdict").isNotNull()), run, "word string, host string, verdict string").distinct()
    sums = per_host.groupBy("word").agg(F.count_if(F.col("verdict") == "block").alias("blocked"), F.count_if(F.col("verdict") == "allow").alias("allowed")).toPandas()
    return {w: (int(b), int(a)) for w, b, a in zip(sums["word"], sums["blocked"], sums["allowed"])}


def train(words: Words, labelled: Sequence[tuple[str, str]], smoothing: float = 0.5, prior: float = -1.0,
          ruled: dict[str, tuple[int, int]] | None = None) -> Bayes:
    """Multinomial naive Bayes over the split words of the labelled names and of the URLs that rules judge. A word of
    neither kind says nothing."""
    model = Bayes(words, prior, {})
    counts = {"block": Counter(), "allow": Counter()}
    for name, kind in labelled:
        counts[kind].update(model.tokens(name, ""))
    for word, (blocked, allowed) in (ruled or {}).items():
        counts["block"][word] += blocked
        counts["allow"][word] += allowed
    vocabulary = set(counts["block"]) | set(counts["allow"])
    totals = {kind: sum(c.values()) + smoothing * len(vocabulary) for kind, c in counts.items()}
    model.odds = {w: math.log((counts["block"][w] + smoothing) / totals["block"]) - math.log((counts["allow"][w] + smoothing) / totals["allow"]) for w in vocabulary}
    return model


def fit(pages: DataFrame, labelled: Sequence[tuple[str, str]] = LABELLED, rules: Sequence[tuple[str, str, str]] = RULES,
        most_words: int = 50_000, prior: float = -2.0) -> Bayes:
    """Words, and what the URLs judged by rules say about them, of all pages."""
    words = word_model(word_frequencies(pages, most_words), labelled)
    return train(words, labelled, prior=prior, ruled=ruled_words(pages, words, rules))


def agreement(pages: DataFrame, labelled: Sequence[tuple[str, str]] = LABELLED, rules: Sequence[tuple[str, str, str]] = RULES) -> DataFrame:
    """(verdict, by_words, n): what the rules and the words say of the URLs of every fifth host, by checksum, when learning
    from those of the other hosts."""
    host, _ = host_and_path(pages["url"])
    held_out = F.crc32(host) % 5 == 0
    model = fit(pages.where(~held_out), labelled, rules)
    judged = judge(pages.where(held_out), model, rules).where(F.col("rule").isNotNull())
    return judged.groupBy("verdict", F.when(F.col("score") > 0, "block").otherwise("allow").alias("by_words")).agg(F.count("*").alias("n"))


def judge(pages: DataFrame, model: Bayes, rules: Sequence[tuple[str, str, str]] = RULES, odds: float = 0.0,
          id_column: str = "page_id", url_column: str = "url") -> DataFrame:
    """(page_id, host, path, rule, verdict, score, words) of every URL. A batch splits each host once."""
    def run(hosts: pa.Array, paths: pa.Array) -> pa.Array:
        split: dict[str, list[str]] = {}
        out = []
        for host, path in zip(hosts.to_pylist(), paths.to_pylist()):
            if len(split) > 100_000:
                split.clear()
            tokens = [*(split.get(host) or split.setdefault(host, model.tokens(host, ""))), *model.tokens("", path)]
            out.append({"score": model.prior + sum(model.odds.get(t, 0.0) for t in tokens), "words": tokens})
        return pa.array(out, pa.struct([("score", pa.float64()), ("words", pa.list_(pa.string()))]))

    host, path = host_and_path(pages[url_column])
    parts = pages.select(pages[id_column].cast("long").alias("page_id"), host.alias("host"), path.alias("path"))
    scored = parts.withColumn("found", F.arrow_udf(by_value(run), "struct<score:double,words:array<string>>")("host", "path"))
    ruled = scored.withColumn("by_rule", rule_of(F.col("host"), F.col("path"), rules))
    own = F.when(F.col("found.score") > odds, "block").otherwise("allow")
    return ruled.select("page_id", "host", "path", F.col("by_rule.rule").alias("rule"), F.coalesce("by_rule.verdict", own).alias("verdict"),
                        F.col("found.score").alias("score"), F.array_join("found.words", " ").alias("words"))
