"""Personal data: base patterns, and a linear-chain conditional random field over word shapes that adds to them.

Base spans are leftmost, not overlapping within a kind, and always stay. The field tags the tokens of windows around
tokens with a digit or an ``@``, with B- and I- tags for each kind; features are the shapes of a token and of its
neighbours, with every letter and digit abstracted away, so that it finds what the patterns drop: a phone and a card
number with one space between them, a number without its country prefix, an address with a letter outside ASCII. Long
windows are decoded in parts that overlap by the longest entity, and tokens end where a script without spaces begins. The
field is trained by gradient steps on the conditional likelihood and decoded by Viterbi over all windows of a batch at once.

The labelled table is made from at most ``train_documents`` documents: windows tagged by the base patterns, copies of
them with the entity written in ways the patterns do not know, and copies with plain numbers in its place, tagged as
none.

Edge cases: null texts are empty and hold nothing; offsets are code points, the end exclusive; rows that repeat are
judged alike; a corpus without any personal data trains on plain numbers only, and adds nothing.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from deckmill.llm.common import id_text, map_arrow, sampled

KINDS = ("email", "ip", "card", "phone")
TAGS = ("O", *(f"{place}-{kind}" for kind in KINDS for place in "BI"))
N_TAGS = len(TAGS)
FEATURES = 1 << 13
CONTEXT = 2
LONGEST_TOKEN = 64
MOST_TOKENS = 48
# A card of 19 digits with a space after each is the entity of most tokens.
MARGIN = 20

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A match that starts inside a run of digits could start at the run as well, so runs are tried once, at their start.
IP = re.compile(r"(?<![0-9])[0-9]++\.([0-9]++)\.([0-9]++)\.([0-9]++)")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
TRIGGER = re.compile(r"[0-9@]")
# Thai, Lao, Burmese, Khmer, and all from the CJK radicals to Hangul, with their wide forms: written without spaces, or
# joined to digits without one
WIDE = "\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u2e80-\ud7ff\uf900-\ufaff\uff00-\uffef\U00020000-\U0003ffff"
RUN = re.compile(f"[{WIDE}]+|[^{WIDE} \\t\\n\\r\\x0b\\x0c]+")
PIECE = re.compile(r"[^,;:|\"'<>\[\]{}=&/\\]+")


def luhn(digits: str) -> bool:
    doubled = sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return (doubled + sum(map(int, digits[::-2]))) % 10 == 0


def only_digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def emails(text: str) -> Iterator[tuple[int, int]]:
    """What ``[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)+`` finds, in one pass: each match has one ``@``."""
    done, at = 0, text.find("@")
    while at >= 0:
        tail = DOMAIN.match(text, at + 1)
        start = at
        if tail:
            while start > done and text[start - 1] in LOCAL:
                start -= 1
        if tail and start < at:
            done = tail.end()
            yield start, done
        at = text.find("@", max(at + 1, done))


def base_spans(text: str) -> list[tuple[str, int, int]]:
    if not TRIGGER.search(text):
        return []
    found = [("email", s, e) for s, e in emails(text)]
    found += [("ip", *m.span()) for m in IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p[-4:]) <= 255 for p in m.group().split("."))]
    for m in CARD.finditer(text):
        digits = only_digits(m.group())
        if 13 <= len(digits) <= 19 and luhn(digits):
            found.append(("card", *m.span()))
    found += [("phone", *m.span()) for m in PHONE.finditer(text) if 9 <= len(only_digits(m.group())) <= 15] if "+" in text else []
    return found


def tokens(text: str) -> Iterator[tuple[int, int]]:
    """Runs between ASCII white space, cut where a script without spaces begins or ends; runs of more than LONGEST_TOKEN
    characters are cut at separators too."""
    for run in RUN.finditer(text):
        if run.end() - run.start() <= LONGEST_TOKEN:
            yield run.span()
        else:
            yield from (piece.span() for piece in PIECE.finditer(text, *run.span()))


def windows_around(text: str, margin: int = 0) -> Iterator[tuple[list[tuple[int, int]], int, int]]:
    """Windows (tokens, first, end) of tokens with a digit or ``@`` and CONTEXT tokens on either side; windows that touch
    are one. A window of more than MOST_TOKENS is cut in parts that overlap by ``margin`` tokens on either side; tokens from
    ``first`` to ``end`` belong to the part, so each token belongs to one."""
    if not TRIGGER.search(text):
        return
    window: list[tuple[int, int]] = []
    waiting: list[tuple[int, int]] = []
    first, after = 0, CONTEXT
    for token in tokens(text):
        if TRIGGER.search(text, *token):
            window += [*waiting, token]
            waiting, after = [], 0
        elif after < CONTEXT:
            window.append(token)
            after += 1
        else:
            waiting.append(token)
            if len(waiting) > CONTEXT:
                del waiting[0]
                if len(window) > first:
                    yield window, first, len(window)
                window, first = [], 0
        while len(window) >= first + MOST_TOKENS + margin + CONTEXT:
            end = first + MOST_TOKENS
            yield window[:end + margin], first, end
            window, first = window[end - margin:], margin
    if len(window) > first:
        yield window, first, len(window)


def trimmed(text: str, start: int, end: int) -> tuple[int, int]:
    while end > start and text[end - 1] in ".,;:!?\"'<>[]{}":
        end -= 1
    while start < end and text[start] in ",;:!?\"'<>[]{}":
        start += 1
    return start, end


SHAPE = str.maketrans({**{chr(c): "9" for c in range(48, 58)}, **{chr(c): "A" for c in range(65, 91)}, **{chr(c): "a" for c in range(97, 123)}})


def shape(token: str) -> str:
    """Letters as a or A, digits as 9, runs with their length up to 16 digits; other letters as a."""
    if len(token) > LONGEST_TOKEN:
        return "long" if TRIGGER.search(token) else "a"
    flat = "".join("a" if ord(c) > 127 and c.isalpha() else c for c in token.translate(SHAPE))
    return re.sub(r"9+", lambda m: f"9{min(len(m.group()), 20)}", re.sub(r"([aA])[aA]*", r"\1", flat))


def features(tokens: list[str]) -> list[list[int]]:
    """Hashed features of each token: its own shape, parts of it, and the shapes around it."""
    shapes = ["<", "<", *map(shape, tokens), ">", ">"]
    out = []
    for i in range(2, len(shapes) - 2):
        own, token = shapes[i], tokens[i - 2]
        coarse = re.sub(r"9\d+", "9", own)
        names = (f"s{own}", f"c{coarse}", f"p{shapes[i - 1]}", f"n{shapes[i + 1]}", f"ps{shapes[i - 1]}|{own}", f"sn{own}|{shapes[i + 1]}",
                 f"pp{shapes[i - 2]}|{shapes[i - 1]}", f"nn{shapes[i + 1]}|{shapes[i + 2]}", f"@{token.count('@')}.{min(4, token.count('.'))}",
                 f"d{min(20, len(only_digits(token)))}", f"f{own[:2]}", f"l{own[-2:]}")
        out.append([zlib.crc32(n.encode()) % FEATURES for n in names])
    return out


@dataclass
class Field:
    """Weights of a linear-chain conditional random field."""
    emit: np.ndarray  # FEATURES x N_TAGS
    step: np.ndarray  # N_TAGS x N_TAGS
    first: np.ndarray

    def scores(self, batch: np.ndarray) -> np.ndarray:
        return self.emit[batch].sum(2)

    def decode(self, windows: list[list[list[int]]]) -> list[list[int]]:
        """Best tags of each window: one Viterbi pass over windows of like length together."""
        out: list[list[int]] = [[] for _ in windows]
        order = sorted(range(len(windows)), key=lambda i: len(windows[i]))
        for at in range(0, len(order), 512):
            some = order[at:at + 512]
            batch, mask = padded([windows[i] for i in some])
            emit = self.scores(batch)
            best, back = emit[:, 0] + self.first, np.zeros((len(some), emit.shape[1], N_TAGS), np.int64)
            for t in range(1, emit.shape[1]):
                through = best[:, :, None] + self.step
                back[:, t] = through.argmax(1)
                moved = through.max(1) + emit[:, t]
                best = np.where(mask[:, t, None], moved, best)
                back[:, t] = np.where(mask[:, t, None], back[:, t], np.arange(N_TAGS))
            tag = best.argmax(1)
            path = np.zeros(batch.shape[:2], np.int64)
            for t in range(emit.shape[1] - 1, -1, -1):
                path[:, t] = tag
                tag = back[np.arange(len(some)), t, tag] if t else tag
            for row, i in enumerate(some):
                out[i] = path[row, :len(windows[i])].tolist()
        return out


def padded(windows: list[list[list[int]]]) -> tuple[np.ndarray, np.ndarray]:
    longest = max(map(len, windows))
    width = len(windows[0][0])
    batch, mask = np.zeros((len(windows), longest, width), np.int64), np.zeros((len(windows), longest), bool)
    for row, window in enumerate(windows):
        batch[row, :len(window)], mask[row, :len(window)] = window, True
    return batch, mask


def train_field(windows: list[list[list[int]]], tags: list[list[int]], rounds: int = 80, rate: float = 0.3, ridge: float = 2e-4) -> Field:
    """Gradient ascent with per-weight step sizes on the conditional log likelihood; forward and backward sums for all
    windows at once."""
    field = Field(np.zeros((FEATURES, N_TAGS)), np.zeros((N_TAGS, N_TAGS)), np.zeros(N_TAGS))
    if not windows:
        return field
    batch, mask = padded(windows)
    n, longest = mask.shape
    gold = np.zeros((n, longest), np.int64)
    for row, own in enumerate(tags):
        gold[row, :len(own)] = own
    seen = [np.full_like(w, 1e-8) for w in (field.emit, field.step, field.first)]
    rows, used = np.arange(n), batch[mask].ravel()
    one = np.eye(N_TAGS)[gold] * mask[..., None]
    pairs_gold = np.einsum("nti,ntj->ij", one[:, :-1], one[:, 1:])

    def lse(x: np.ndarray, axis: int) -> np.ndarray:
        top = x.max(axis, keepdims=True)
        return (np.log(np.exp(x - top).sum(axis, keepdims=True)) + top).squeeze(axis)

    for _ in range(rounds):
        emit = field.scores(batch)
        ahead, behind = np.zeros((n, longest, N_TAGS)), np.zeros((n, longest, N_TAGS))
        ahead[:, 0] = emit[:, 0] + field.first
        for t in range(1, longest):
            moved = lse(ahead[:, t - 1, :, None] + field.step, 1) + emit[:, t]
            ahead[:, t] = np.where(mask[:, t, None], moved, ahead[:, t - 1])
        total = lse(ahead[:, -1], 1)
        for t in range(longest - 2, -1, -1):
            moved = lse((behind[:, t + 1] + emit[:, t + 1])[:, None, :] + field.step, 2)
            behind[:, t] = np.where(mask[:, t + 1, None], moved, behind[:, t + 1])
        unary = np.exp(ahead + behind - total[:, None, None]) * mask[..., None]
        joint = np.exp(ahead[:, :-1, :, None] + field.step + (emit + behind)[:, 1:, None, :] - total[:, None, None, None]) * mask[:, 1:, None, None]
        error = one - unary
        slopes = [np.zeros_like(field.emit), pairs_gold - joint.sum((0, 1)), error[rows, 0].sum(0)]
        for tag in range(N_TAGS):
            slopes[0][:, tag] = np.bincount(used, np.repeat(error[..., tag][mask], batch.shape[2]), FEATURES)
        for weights, slope, past in zip((field.emit, field.step, field.first), slopes, seen):
            slope = slope / n - ridge * weights
            past += slope ** 2
            weights += rate * slope / np.sqrt(past)
    return field


def tags_of(windows: list[tuple[int, int]], spans: list[tuple[str, int, int]]) -> list[int]:
    out, last = [], None
    for start, end in windows:
        span = next((s for s in spans if s[1] < end and start < s[2]), None)
        out.append(0 if span is None else TAGS.index(f"{'I' if span == last else 'B'}-{span[0]}"))
        last = span
    return out


def examples(text: str) -> list[tuple[list[str], list[int]]]:
    """Labelled windows of one text, with rewritten copies. Draws follow from a checksum of the window."""
    spans, out = base_spans(text), []
    for window, _, _ in windows_around(text):
        words, tags = [text[s:e] for s, e in window], tags_of(window, spans)
        rng = np.random.default_rng(zlib.crc32(" ".join(words).encode()))
        numbers = ["7", "42", "350", "2019", "48213", "730154", "3.14", "12:30", "2021-05-03", "1.2.3", "99%", "4,500", "v2.0", "10.5.", "(1998)", "1/2", "25-30", "#17"]
        kinds = {TAGS[t][2:] for t in tags if t}
        # a number followed by another one runs on for the base patterns, so its tags are not to be trusted
        if not kinds and any(len(only_digits(w)) >= 7 and not any(c.isalpha() for c in w) for w in words):
            continue
        out.append((words, tags))
        plain = [w for w in words if not TRIGGER.search(w)]
        left, right = plain[:CONTEXT] or ["a"], plain[-CONTEXT:] or ["a"]
        number = [numbers[k] for k in rng.integers(0, len(numbers), int(rng.integers(1, 3)))]
        out.append(([*left, *number, *right], [0] * (len(left) + len(number) + len(right))))

        def entity(words: list[str], kind: str) -> tuple[list[str], list[int]]:
            return words, [TAGS.index(f"{'I' if i else 'B'}-{kind}") for i in range(len(words))]

        d = "".join(map(str, rng.integers(0, 10, 16)))
        forms = {"phone": [entity([f"+{d[0]}", f"({d[1:4]})", f"{d[4:7]}-{d[7:11]}"], "phone"), entity([f"({d[1:4]})", f"{d[4:7]}-{d[7:11]}"], "phone"),
                           entity([f"{d[1:4]}-{d[4:7]}-{d[7:11]}"], "phone"), entity([f"{d[1:4]}.{d[4:7]}.{d[7:11]}"], "phone")],
                 "card": [entity([d], "card"), entity([d[i:i + 4] for i in range(0, 16, 4)], "card"), entity(["-".join(d[i:i + 4] for i in range(0, 16, 4))], "card")],
                 "ip": [entity([".".join(str(int(v)) for v in rng.integers(1, 255, 4))], "ip")],
                 "email": [entity([f"ab{'éößñ'[int(d[0]) % 4]}.{d[:2]}@mail{d[3]}.example.com"], "email"), entity([f"abc.{d[:2]}@mail{d[3]}.example.com"], "email")]}
        if kinds:
            def some(kind: str) -> tuple[list[str], list[int]]:
                return forms[kind][int(rng.integers(0, len(forms[kind])))]

            for kind in KINDS:
                own, marks = some(kind)
                out.append(([*left, *own, *right], [0] * len(left) + marks + [0] * len(right)))
            one, other = (some(KINDS[k]) for k in rng.integers(0, len(KINDS), 2))  # two in a row
            out.append(([*left, *one[0], *other[0], *right], [0] * len(left) + one[1] + other[1] + [0] * len(right)))
    return out


def train(docs: DataFrame, train_documents: int = 4000, most_windows: int = 2000, id_column: str = "doc_id", text_column: str = "text") -> Field:
    """Fit on windows of a bounded sample of the documents with a digit or ``@``, drawn by hash."""
    texts = id_text(docs, id_column, text_column).where(F.col("text").rlike("[0-9@]"))
    sample = sampled(texts, ["doc_id", "text"], train_documents).select("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [x for text in batch.column(0).to_pylist() for x in examples(text)]
            yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in found], pa.list_(pa.string())), pa.array([x[1] for x in found], pa.list_(pa.int64()))], ["words", "tags"])

    labelled = map_arrow(sample, run, "words array<string>, tags array<long>").distinct() \
        .orderBy(F.xxhash64("words"), "words", "tags").limit(most_windows).toPandas()
    return train_field([features(list(w)) for w in labelled["words"]], [list(t) for t in labelled["tags"]])


def fits(kind: str, text: str) -> bool:
    """The checks on values that hold for base spans hold for added ones."""
    digits = only_digits(text)
    if kind == "card":
        return 13 <= len(digits) <= 19 and luhn(digits)
    if kind == "ip":
        parts = text.split(".")
        return len(parts) == 4 and all(p.isdigit() and len(p) <= 3 and int(p) <= 255 for p in parts)
    return "@" in text if kind == "email" else 7 <= len(digits) <= 15


def apart(spans: list[tuple[str, int, int]]) -> tuple[list[int], list[int]]:
    """Starts and ends of the stretches that the spans cover."""
    starts, ends = [], []
    for _, start, end in sorted(spans, key=lambda s: s[1]):
        if ends and start <= ends[-1]:
            ends[-1] = max(ends[-1], end)
        else:
            starts.append(start)
            ends.append(end)
    return starts, ends


def spans_of(window: list[tuple[int, int]], tags: list[int], first: int, end: int) -> list[tuple[str, int, int]]:
    """Spans that begin with one of the tokens from ``first`` to ``end``."""
    spans: list[tuple[int, str, int, int]] = []
    open_kind = None
    for at, ((begin, stop), tag) in enumerate(zip(window, tags)):
        kind = TAGS[tag][2:] if tag else None
        if kind and (tag % 2 == 1 or kind != open_kind):
            spans.append((at, kind, begin, stop))
        elif kind:
            spans[-1] = (*spans[-1][:3], stop)
        open_kind = kind
    return [span[1:] for span in spans if first <= span[0] < end]


def added_spans(texts: list[str], base: list[list[tuple[str, int, int]]], field: Field, at_once: int = 2048) -> list[list[tuple[str, int, int]]]:
    """Spans of the field that touch no base span, nor one before that begins in another part of their window. Windows are
    decoded ``at_once``, so that work space does not follow the texts."""
    out: list[list[tuple[str, int, int]]] = [[] for _ in texts]
    covered = [apart(own) for own in base]

    def decode(some: list[tuple[int, list[tuple[int, int]], int, int]]) -> None:
        tagged = field.decode([features([texts[i][s:e] for s, e in window]) for i, window, _, _ in some])
        for (i, window, first, end), tags in zip(some, tagged):
            starts, ends = covered[i]
            for kind, start, stop in spans_of(window, tags, first, end):
                if start >= stop or not fits(kind, texts[i][start:stop]):
                    continue
                before = bisect_left(starts, stop) - 1
                if (before < 0 or ends[before] <= start) and (not out[i] or out[i][-1][2] <= start):
                    out[i].append((kind, start, stop))

    waiting = []
    for i, text in enumerate(texts):
        for window, first, end in windows_around(text, MARGIN):
            waiting.append((i, [trimmed(text, *t) for t in window], first, end))
            if len(waiting) == at_once:
                decode(waiting)
                waiting = []
    if waiting:
        decode(waiting)
    return out


def joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in sorted(set(spans), key=lambda x: (KINDS.index(x[0]), x[1], x[2])))


def find(docs: DataFrame, field: Field, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added): counts and digest of the base spans, and all
    spans."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).to_pylist()
            base = [base_spans(t) for t in texts]
            more = added_spans(texts, base, field)
            counts = [pa.array([sum(s[0] == kind for s in own) for own in base], pa.int64()) for kind in KINDS]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *counts, pa.array([hashlib.sha256(joined(own).encode()).hexdigest() for own in base]),
                 pa.array([joined([*a, *b]) for a, b in zip(base, more)]), pa.array([len(m) for m in more], pa.int64())],
                ["doc_id", *[f"n_{k}" for k in KINDS], "base_sha256", "spans", "n_added"])

    return map_arrow(id_text(docs, id_column, text_column), run,
                     f"doc_id long, {', '.join(f'n_{k} long' for k in KINDS)}, base_sha256 string, spans string, n_added long")
