"""Personal data in text: fixed patterns, and a character tagger that adds what they miss.

The tagger is a bidirectional LSTM with CRF transitions, trained from labelled
spans. It reads whole texts, in pieces that overlap; digits and signs of other
scripts and widths count as the plain ones. Overlapping windows cover each
piece; their scores are averaged, nearer window centres counting more, and one
best tag sequence is decoded for the whole piece.
"""

from __future__ import annotations

import random
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetwatt.llm.common import id_text, steps, table, text_steps
from fleetwatt.llm.tagger import Tagger

KINDS = ("email", "ip", "card", "phone")
# The patterns of the base kinds.
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
# The same, but a run of digits that begins no address is taken whole: within it none can begin either.
IP_OR_RUN = re.compile(r"[0-9]++(?:\.[0-9]++\.[0-9]++(\.[0-9]+))?")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
NOT_DIGIT = re.compile(r"[^0-9]")

# A digit, a sign or an "at" in brackets: as one set of first characters, which is searched faster than two ways.
EVIDENCE = re.compile(r"[0-9@(\[{](?:(?<=[0-9@])|(?<=[(\[{]) ?[Aa][Tt] ?[)\]}])")
REACH = 32  # characters of the corpus taken for training on either side of evidence
PIECE = 8192
MARGIN = 128  # of a piece, where spans belong to the neighbour
# Digits and signs in other forms, each one character for one.
PLAIN = {0xFEE0 + c: c for c in range(0x21, 0x7F)} | {start + i: 48 + i for start in (0x660, 0x6F0, 0x966) for i in range(10)} | {0xFE6B: 64}
# A bare "at" asks for a spelled "dot" too: "look at example.com" names nobody.
SPELLED_DOT = r"(?: ?[(\[{] ?dot ?[)\]}] ?| dot )"
SPELLED = (
    r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++(?: ?(?:@|[(\[{] ?at ?[)\]}]) ?[A-Za-z0-9-]++(?:(?:\.|" + SPELLED_DOT + r")[A-Za-z0-9-]++)+"
    r"| at [A-Za-z0-9-]++(?:" + SPELLED_DOT + r"[A-Za-z0-9-]++)+)"
)
AT = re.compile(r"@|[(\[{] ?at ?[)\]}]| at ", re.IGNORECASE)
BRACKETED = re.compile(r"[(\[{] ?at ?[)\]}]", re.IGNORECASE)
DOT = re.compile(r"\.|" + SPELLED_DOT, re.IGNORECASE)
ONLY_SPELLED_DOT = re.compile(SPELLED_DOT, re.IGNORECASE)
# Forms that the fixed patterns miss, by kind: to label stretches of the corpus.
LOOSE = (
    re.compile(SPELLED, re.IGNORECASE),
    re.compile(r"(?<![0-9.])[0-9]{1,3}(?:(?:\[\.\]|\(\.\)|\.)[0-9]{1,3}){3}(?![0-9.])"),
    re.compile(r"(?<![0-9])[0-9](?:[\x20.-]?[0-9]){12,18}(?![0-9])"),
    re.compile(r"(?<![0-9.+-])(?:(?:001|\+?1)[ .-])?(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9])"),
)
# Windows overlap by WINDOW - STRIDE characters, whose scores are averaged; texts for training are cut at TRAINED.
WINDOW = 512
STRIDE = 480
TRAINED = 96
ENDING = 16  # empty places behind a text, as those behind a shorter one in training
BATCH = 512  # windows read at once
HELD = 1 << 20  # characters whose scores are held at once, about
# Bounds of training.
CORPUS_WINDOWS = 600
MADE_WINDOWS = 2400
EPOCHS = 6

Span = tuple[int, int, int]  # start, kind, end


def luhn(digits: str) -> bool:
    total = 0
    for i, ch in enumerate(reversed(digits)):
        value = ord(ch) - 48
        total += value if i % 2 == 0 else value * 2 - 9 * (value > 4)
    return total % 10 == 0


def base_spans(text: str) -> list[Span]:
    """All matches of the fixed kinds, by start and kind. Kinds may overlap each other."""
    found: list[Span] = []
    end = 0
    at = text.find("@")
    while at >= 0:
        # The longest run before the sign, not into the match before: where a
        # search from the left would have begun.
        start = at
        while start > end and text[start - 1] in LOCAL:
            start -= 1
        match = DOMAIN.match(text, at) if start < at else None
        if match:
            end = match.end()
            found.append((start, 0, end))
        at = text.find("@", max(at + 1, end))
    for m in IP_OR_RUN.finditer(text):
        if m[1] and all(len(part.lstrip("0")) <= 3 and int(part.lstrip("0") or 0) <= 255 for part in m[0].split(".")):
            found.append((m.start(), 1, m.end()))
    for m in CARD.finditer(text):
        digits = NOT_DIGIT.sub("", m[0])
        if 14 <= len(digits) <= 19 and luhn(digits):
            found.append((m.start(), 2, m.end()))
    for m in PHONE.finditer(text):
        if 10 <= len(NOT_DIGIT.sub("", m[0])) <= 15:
            found.append((m.start(), 3, m.end()))
    return sorted(found)


OTHER_FORMS = re.compile("[" + "".join(map(chr, PLAIN)) + "]")


def plain(text: str) -> str:
    """The text, character for character, with plain digits and signs."""
    return text if text.isascii() or not OTHER_FORMS.search(text) else text.translate(PLAIN)


def maybe_spelled(read: str) -> bool:
    """Whether the text may hold what SPELLED describes: a sign, one in brackets, or a bare "at", which asks for a "dot"."""
    return "@" in read or BRACKETED.search(read) is not None or "dot" in read.lower()


def loose_spans(text: str) -> list[Span]:
    """Base spans, and what is written in other forms and touches none."""
    read = plain(text)
    found = base_spans(text)
    for kind, pattern in enumerate(LOOSE):
        for m in pattern.finditer(read):
            span = (m.start(), kind, m.end())
            if plausible(text, span) and all(m.end() <= s or m.start() >= e for s, _, e in found):
                found.append(span)
    return sorted(found)


SYMBOLS = " @.-_+()[]{}:/,;%#&*!?=\"'\n"


def symbol_ids(text: str) -> np.ndarray:
    """A small number per character: its class, or itself for the characters that matter."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    return SYMBOL_TABLE[np.minimum(codes, len(SYMBOL_TABLE) - 1)]


SYMBOL_TABLE = np.full(1 << 16, 3, np.uint8)  # 0 padding, 1 digit, 2 lower, 3 other, 4 upper
SYMBOL_TABLE[48:58] = 1
SYMBOL_TABLE[97:123] = 2
SYMBOL_TABLE[65:91] = 4
SYMBOL_TABLE[[ord(c) for c in "atdoATDO"]] = [5, 6, 7, 8, 5, 6, 7, 8]  # of "at" and "dot"
for _n, _c in enumerate(SYMBOLS):
    SYMBOL_TABLE[ord(_c)] = 9 + _n
SYMBOL_TABLE[list(PLAIN)] = SYMBOL_TABLE[list(PLAIN.values())]
SYMBOL_COUNT = 9 + len(SYMBOLS)
TAGS = 1 + 2 * len(KINDS)  # outside; begin and inside of each kind


def tag_line(length: int, spans: list[Span]) -> np.ndarray:
    tags = np.zeros(length, np.int8)
    for start, kind, end in spans:
        if not tags[start:end].any():
            tags[start:end] = 2 + 2 * kind
            tags[start] = 1 + 2 * kind
    return tags


def spans_of(tags: np.ndarray) -> list[Span]:
    """Runs of one kind; an inside tag without a begin opens a span too."""
    at = np.flatnonzero(tags)
    if not len(at):
        return []
    tags = tags[at]
    own = (tags.astype(np.int64) + 1) // 2
    joined = (at[1:] == at[:-1] + 1) & (own[1:] == own[:-1]) & (tags[1:] % 2 == 0)
    begins, ends = np.concatenate([[True], ~joined]), np.concatenate([~joined, [True]])
    return list(zip(at[begins].tolist(), (own[begins] - 1).tolist(), (at[ends] + 1).tolist(), strict=True))


def plausible(text: str, span: Span) -> bool:
    """What a span of a kind must have at least: it starts and ends well and has enough digits."""
    start, kind, end = span
    value = plain(text[start:end])
    digits = len(NOT_DIGIT.sub("", value))
    if value != value.strip():
        return False
    if kind == 0:
        at = AT.search(value)
        return len(value) >= 6 and at is not None and (ONLY_SPELLED_DOT if at[0].lower() == " at " else DOT).search(value, at.end()) is not None
    low, high = ((4, 12), (13, 19), (7, 15))[kind - 1]
    if not low <= digits <= high or not value[-1].isdigit():
        return False
    if kind == 1:
        return all(part.isdigit() and int(part) <= 255 for part in re.split(r"\.|\[\.\]|\(\.\)", value) if len(part) < 9)
    return kind != 2 or luhn(NOT_DIGIT.sub("", value))


def made_windows(count: int = MADE_WINDOWS, seed: int = 7) -> list[tuple[str, list[Span]]]:
    """Labelled spans to start from: prose with data of each kind in many forms, and numbers that are none."""
    rng = random.Random(seed)
    syllables = "th er on an re he in ed nd ha at en es of or nt ea ti to it st io le is ou ar as de rt ve é ü ñ ción ung".split()

    def word() -> str:
        made = "".join(rng.choice(syllables) for _ in range(rng.randint(1, 4)))
        return rng.choice([made, made, made, made.capitalize(), made.upper(), made + rng.choice(".,!?;:")])

    def digits(n: int) -> str:
        return "".join(rng.choice("0123456789") for _ in range(n))

    def name() -> str:
        return "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(2, 8)))

    def card() -> str:
        body = digits(rng.choice([13, 14, 15, 15, 15, 18]))
        body = next(body + d for d in "0123456789" if luhn(body + d))
        step = rng.choice([0, 0, 4])
        if step:
            return rng.choice([" ", "-", "."]).join(body[i : i + 4] for i in range(0, len(body), 4))
        return body

    def item() -> tuple[str, int]:
        kind = rng.randrange(4)
        if kind == 0:
            user = name() + rng.choice(["", "." + name(), "_" + name(), "." + digits(2), digits(2), "+" + name()])
            host = ".".join([name() + rng.choice(["", digits(1)]), *([name()] if rng.random() < 0.3 else []), rng.choice(["com", "org", "net", "de", "example"])])
            at = rng.choice(["@"] * 6 + [" (at) ", " [at] ", "(at)", "[at]"])
            if rng.random() < 0.2:
                at, host = " at ", host.replace(".", " dot ")
            return user + at + host, 0
        if kind == 1:
            sign = rng.choice([".", ".", ".", ".", "[.]"])
            return sign.join(str(rng.randint(0, 255)) for _ in range(4)), 1
        if kind == 2:
            return card(), 2
        a, b, c = digits(3), digits(3), digits(4)
        lead = rng.choice(["+1 ", "+1 ", "+" + digits(2) + " ", "1-", "", "", "001 "])
        return rng.choice([f"{lead}({a}) {b}-{c}", f"{lead}{a}-{b}-{c}", f"{lead}{a}.{b}.{c}", f"{lead}{a} {b} {c}"]), 3

    def other() -> str:
        return rng.choice(
            [
                str(rng.randint(1900, 2030)), f"{rng.randint(1, 9)}.{rng.randint(0, 9)}", f"Version {rng.randint(1, 4)}.0", "CC BY-NC 4.0", f"{rng.randint(1, 12)}:{digits(2)}",
                f"{rng.randint(2000, 2030)}-0{rng.randint(1, 9)}-1{rng.randint(0, 9)}", f"{digits(2)}%", f"{digits(3)},{digits(3)}", "#" + digits(4), digits(rng.randint(1, 6)), "@" + name(),
                f"{rng.randint(1, 9)}.{digits(1)}.{digits(2)}", f"AKIA{digits(2)}{name().upper()}{digits(3)}", "".join(rng.choice("0123456789abcdef") for _ in range(rng.randint(18, 40))), f"$ {digits(2)}.{digits(2)}", digits(rng.randint(20, 30)), "!!", "***", "|",
                f"at {name()}", f"{name()} at {name()} {name()}", f"a dot {name()}", f"{name()} at {digits(1)}.{digits(2)}",
            ]
        )

    made = []
    for _ in range(count):
        text, spans = " ".join(word() for _ in range(rng.randint(0, 7))), []
        for _ in range(rng.choice([0, 1, 1, 1, 2, 2])):
            text += " " if text else ""
            if rng.random() < 0.6:
                value, kind = item()
                spans.append((len(text), kind, len(text) + len(value)))
            else:
                value = other()
            text += value + rng.choice(["", "", ",", "."])
            text += " " + " ".join(word() for _ in range(rng.randint(1, 6)))
        shift = rng.randint(0, 12)
        made.append((text[shift:], [(s - shift, k, e - shift) for s, k, e in spans if s >= shift]))
    return made


def evident(text: str, count: int) -> list[tuple[int, int]]:
    """The first ``count`` parts of the text within REACH of evidence; parts that touch are one."""
    out: list[tuple[int, int]] = []
    for m in EVIDENCE.finditer(text):
        start, end = max(0, m.start() - REACH), min(len(text), m.end() + REACH)
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], end)
        elif len(out) == count:
            break
        else:
            out.append((start, end))
    return out


def stretches(text: str) -> list[tuple[int, int]]:
    """Pieces of at most PIECE characters that cover the text, each sharing twice MARGIN with the next."""
    last = max(1, len(text) - 2 * MARGIN)
    return [(a, min(len(text), a + PIECE)) for a in range(0, last, PIECE - 2 * MARGIN)] if text else []


def corpus_windows(documents: DataFrame, count: int = CORPUS_WINDOWS) -> list[tuple[str, list[Span]]]:
    """At most ``count`` stretches of the corpus with their spans, fixed patterns and loose ones, chosen by a hash of their text."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, _, _ in text_steps(batches):
            parts: list[str] = []
            for text in batch.column(1).to_pylist():
                parts += [text[a : min(b, a + TRAINED)] for a, b in evident(text or "", 2)]
            yield pa.RecordBatch.from_arrays([pa.array(sorted(set(parts)), pa.string())], names=["part"])

    parts = id_text(documents).mapInArrow(cut, "part string").orderBy(F.xxhash64("part", F.lit(3)), "part").limit(count)
    return [(row.part, loose_spans(row.part)) for row in parts.collect()]


def train(labelled: list[tuple[str, list[Span]]], epochs: int = EPOCHS) -> Tagger:
    """A tagger from texts with labelled spans; each text counts with its first TRAINED characters."""
    x = np.zeros((len(labelled), TRAINED), np.uint8)
    y = np.zeros((len(labelled), TRAINED), np.int8)
    for row, (text, spans) in enumerate(labelled):
        ids = symbol_ids(text)[:TRAINED]
        x[row, : len(ids)] = ids
        y[row, : len(ids)] = tag_line(max(len(text), TRAINED), [s for s in spans if s[2] <= TRAINED])[: len(ids)]
    tagger = Tagger.fresh(SYMBOL_COUNT, TAGS)
    tagger.train(x, y, epochs)
    return tagger


def windows(length: int) -> list[tuple[int, int]]:
    """As few windows as cover the length, of about one size, so that batches of them need little filling."""
    shared = WINDOW - STRIDE
    count = max(1, -(-(length - shared) // STRIDE))
    step = -(-(length - shared) // count)
    return [(a, min(length, a + step + shared)) for a in range(0, count * step, step)] if count > 1 else [(0, length)]


def text_scores(tagger: Tagger, parts: list[str]) -> list[np.ndarray]:
    """Scores of the tags (time x tags) of each part; where windows overlap, one fades into the next. Equal windows are read once."""
    shared = WINDOW - STRIDE
    fade = (np.arange(1, shared + 1, dtype=np.float32) / (shared + 1))[:, None]
    ids = [np.concatenate([symbol_ids(p), np.zeros(ENDING, np.uint8)]) for p in parts]
    seen: dict[bytes, int] = {}
    where = [[(a, b, seen.setdefault(i[a:b].tobytes(), len(seen))) for a, b in windows(len(i))] for i in ids]
    kept = list(seen)
    made: list[np.ndarray] = [np.zeros((0, TAGS), np.float32)] * len(kept)
    # Windows of about one length share a batch, so that short texts cost what they hold.
    order = sorted(range(len(kept)), key=lambda n: len(kept[n]))
    for at in range(0, len(order), BATCH):
        some = order[at : at + BATCH]
        lengths = np.array([len(kept[n]) for n in some])
        x = np.zeros((len(some), lengths[-1]), np.uint8)
        for row, n in enumerate(some):
            x[row, : len(kept[n])] = np.frombuffer(kept[n], np.uint8)
        scores = tagger.emissions(x, lengths)
        for row, n in enumerate(some):
            made[n] = scores[row, : len(kept[n])]
    out = []
    for i, cuts in zip(ids, where, strict=True):
        total = np.empty((len(i), TAGS), np.float32)
        for a, b, n in cuts:
            own = made[n]
            if a:
                total[a : a + shared] += fade * (own[:shared] - total[a : a + shared])
                total[a + shared : b] = own[shared:]
            else:
                total[:b] = own
        out.append(total[:-ENDING])
    return out


def tagged(tagger: Tagger, parts: list[str]) -> list[np.ndarray]:
    """Best tags of each part, decoded over the whole part."""
    return tagger.decoded(text_scores(tagger, parts))


def added_spans(tagger: Tagger, texts: list[str], bases: list[list[Span]]) -> list[list[Span]]:
    """Spans of the tagger, and spelled-out addresses beside them, that touch no base span."""
    cuts = [(i, a, b) for i, text in enumerate(texts) for a, b in stretches(text)]
    out: list[list[Span]] = [[] for _ in texts]
    # Equal pieces, of copies above all, are read once.
    parts = list(dict.fromkeys(texts[i][a:b] for i, a, b in cuts))
    tags: dict[str, np.ndarray] = {}
    for at, stop in steps(np.cumsum([0, *map(len, parts)]), HELD):
        some = parts[at:stop]
        tags.update(zip(some, tagged(tagger, some), strict=True))
    for i, a, b in cuts:
        for start, kind, end in spans_of(tags[texts[i][a:b]]):
            span = (start + a, kind, end + a)
            # Of two pieces that share a span, the one that sees it from further inside has it.
            if (a and start < MARGIN) or (b < len(texts[i]) and span[0] >= b - MARGIN):
                continue
            if plausible(texts[i], span) and all(span[2] <= s or span[0] >= e for s, _, e in bases[i]):
                out[i].append(span)
    # Spelled-out addresses that the tagger has not found.
    for i, text in enumerate(texts):
        read = plain(text)
        for m in LOOSE[0].finditer(read) if maybe_spelled(read) else ():
            span = (m.start(), 0, m.end())
            if plausible(text, span) and all(span[2] <= s or span[0] >= e for s, _, e in bases[i] + out[i]):
                out[i].append(span)
    return out


@dataclass
class Finder:
    tagger: Tagger

    def find(self, texts: list[str]) -> tuple[list[list[Span]], list[list[Span]]]:
        """Base spans and added spans of each text."""
        bases = [base_spans(text) for text in texts]
        return bases, added_spans(self.tagger, texts, bases)


SPANS = "array<struct<start:int,kind:string,end:int,base:boolean>>"


def find(documents: DataFrame, finder: Finder) -> DataFrame:
    """doc_id, spans: start, kind, end in code points of all personal data, by start and kind; ``base`` marks fixed patterns.

    NULL and empty texts have none. Each row is read alone and whole, so
    repeated rows and NULL ids each give their row. Other columns are left out.
    """
    shared = documents.sparkSession.sparkContext.broadcast(finder)
    kind = pa.list_(pa.struct([("start", pa.int32()), ("kind", pa.string()), ("end", pa.int32()), ("base", pa.bool_())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch, _, _ in text_steps(batches):
            bases, added = known.find([text or "" for text in batch.column(1).to_pylist()])
            spans: list[list[dict]] = []
            for base, more in zip(bases, added, strict=True):
                every = sorted([(*s, True) for s in base] + [(*s, False) for s in more])
                spans.append([dict(start=s, kind=KINDS[k], end=e, base=b) for s, k, e, b in every])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(spans, kind)], names=["doc_id", "spans"])

    return id_text(documents).mapInArrow(run, f"doc_id long, spans {SPANS}")


def op3_pii(spark, sf_dir: str) -> DataFrame:
    """Personal data of all documents. Counts and digest are of the base spans, ``spans`` and ``n_added`` tell of all."""
    documents = table(spark, sf_dir, "documents")
    finder = Finder(train(made_windows() + corpus_windows(documents)))
    found = find(documents, finder)
    base = F.filter("spans", lambda s: s["base"])

    def line(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def count(spans, kind):
        return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")

    return found.select(
        "doc_id",
        *[count(base, kind).alias(f"n_{kind}") for kind in KINDS],
        F.sha2(line(base).cast("binary"), 256).alias("base_sha256"),
        line(F.col("spans")).alias("spans"),
        F.size(F.filter("spans", lambda s: ~s["base"])).cast("long").alias("n_added"),
    )
