"""Personal data: fixed formats, and identifiers found by bootstrapped contextual extraction.

* Formats (e-mail, IP, card, phone) are read from every text. They, and tokens that look random
  (kind ``secret``), are the seeds.
* The surroundings of seeds and other candidates are patterns: the one to three words before, a key
  (``password=``), or capitals that begin the token. They form a graph with the instances.
* Spark scores the graph in turns: a pattern by the share of its occurrences whose instance is of a kind,
  an instance by the patterns it occurs in. How often words stand before anything else is counted over all texts.
* Patterns of high confidence that rest on several different seeds mark further instances as spans: the
  candidates they surround, and in a last scan any token that follows them, whatever its length or characters.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plumbline.llm.words import Words, grams, pieces, texts_of, word_hashes
from plumbline.sources.staging import Staging

BASE_KINDS = ("email", "ip", "card", "phone")
SECRET = "secret"
CONTEXT_WORDS = 3
SUPPORT, CONFIDENCE, TURNS = 3, 0.6, 3
_SECRET_CHARS, _SECRET_BITS = 16, 3.0
_TABLE_BITS = 22  # size of the table that tells counted patterns; the same for any corpus

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]+)\.([0-9]+)\.([0-9]+)")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_CANDIDATE = re.compile(r"(?<![A-Za-z0-9])[A-Za-z0-9][A-Za-z0-9._%+@:/-]{4,}(?<=[A-Za-z0-9])")
_KEY = re.compile(r"([A-Za-z][A-Za-z_-]{1,30})[ ]?[=:][ ]?[\"']?$")
_KEYED = re.compile(r"(?<![A-Za-z_-])[A-Za-z][A-Za-z_-]{1,30}[ ]?[=:][ ]?[\"']?([^\s\"'<>,;]{4,})")
# A key, from its mark backwards, and the value behind the mark.
_MARK, _NAME = re.compile("[=:]"), re.compile(r"(?<![A-Za-z_-])([A-Za-z][A-Za-z_-]{1,30})[ ]?\Z")
_VALUE = re.compile(r"[ ]?[\"']?([^\s\"'<>,;]+)")
_CAPITALS = re.compile(r"[A-Z]{4}(?=[A-Z0-9]{8,}$)")
MARKED = "[0-9@=:]"  # a text without such a character holds no seed, candidate or key
_OPENING, _CLOSING = b"\"'([{<", b".,;:!?)]}>\"'"  # what may stand around a token that is no part of it
_MARKS = np.zeros(256, bool)
_MARKS[[*range(48, 58), ord("@"), ord("="), ord(":")]] = True

Span = tuple[int, int, str]


def _luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        value = int(d) * (1 + k % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def base_spans(text: str) -> list[Span]:
    """Spans (start, end, kind) of the four formats, leftmost and apart from each other within a kind; sorted."""
    found: list[Span] = []
    at = text.find("@")
    last = 0
    while at >= 0:
        start = at
        while start > last and text[start - 1] in _LOCAL:
            start -= 1
        match = _DOMAIN.match(text, at) if start < at else None
        if match:
            last = match.end()
            found.append((start, last, "email"))
        at = text.find("@", max(at + 1, last))
    for match in _IP.finditer(text):
        if all(len(part.lstrip("0")) <= 3 and int(part.lstrip("0") or 0) <= 255 for part in match.groups()):
            found.append((match.start(), match.end(), "ip"))
    for match in _CARD.finditer(text):
        digits = match.group().replace(" ", "").replace("-", "")
        if 12 <= len(digits) <= 19 and _luhn(digits):
            found.append((match.start(), match.end(), "card"))
    for match in _PHONE.finditer(text):
        if 9 <= sum(map(str.isdigit, match.group())) <= 15:
            found.append((match.start(), match.end(), "phone"))
    return sorted(found, key=lambda span: (span[0], BASE_KINDS.index(span[2])))


def looks_random(token: str) -> bool:
    """Long, of letters and digits without pauses, and with many bits of entropy per character."""
    if len(token) < _SECRET_CHARS or not re.fullmatch(r"[A-Za-z0-9_+/-]+", token):
        return False
    digits = sum(map(str.isdigit, token))
    if not 2 <= digits < len(token):
        return False
    entropy = -sum(n / len(token) * math.log2(n / len(token)) for n in Counter(token).values())
    return entropy >= _SECRET_BITS


def _signed(value: int) -> int:
    return value - (1 << 64) if value >= 1 << 63 else value


def patterns_before(text: str, start: int, token: str, hashes) -> list[tuple[int, bool]]:
    """Hashes of the patterns around a token, and whether they are words before it (which other texts must be counted for)."""
    left = text[max(0, start - 200) : start]
    out = []
    if key := _KEY.search(left):
        out.append((_signed(xxhash.xxh3_64_intdigest(b"key " + key[1].lower().encode())), False))
    if capitals := _CAPITALS.match(token):
        out.append((_signed(xxhash.xxh3_64_intdigest(b"capitals " + capitals[0].encode())), False))
    if not left or left[-1] in " \t\n\r\x0b\x0c":
        words = left.encode().lower().split()
        if start > 200:
            words = words[1:]  # may be cut
        codes = hashes.of(words[-CONTEXT_WORDS:])
        for n in range(1, len(codes) + 1):
            out.append((int(grams(codes[-n:], n).view(np.int64)[0]), True))
    return out


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each text its base spans and all candidates with their patterns."""
    hashes = word_hashes()
    span = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.string())])
    pattern = pa.struct([("pattern", pa.int64()), ("counted", pa.bool_())])
    candidate = pa.struct(
        [("start", pa.int64()), ("end", pa.int64()), ("instance", pa.int64()), ("seed", pa.string()), ("patterns", pa.list_(pattern))]
    )
    for batch in pieces(batches, "text"):
        texts = texts_of(batch.column("text"))
        joined = _MARKS[np.frombuffer(b"\n".join(texts), np.uint8)]
        upto = np.concatenate([[0], np.cumsum(joined)])
        ends = np.cumsum([len(t) + 1 for t in texts])
        marked = upto[np.minimum(ends, len(joined))] > upto[ends - [len(t) + 1 for t in texts]]
        all_spans, all_candidates = [], []
        for raw, yes in zip(texts, marked.tolist()):
            spans, candidates = [], []
            if yes:
                text = raw.decode("utf-8", "replace")
                spans = base_spans(text)
                taken = [(a, b, kind) for a, b, kind in spans]
                found = {(a, b): kind for a, b, kind in reversed(spans)}
                busy = _Busy(spans)
                for match in _CANDIDATE.finditer(text):
                    token = match.group()
                    if any(map(str.isdigit, token)) and not busy(match.start(), match.end()):
                        found.setdefault((match.start(), match.end()), SECRET if looks_random(token) else None)
                for match in _KEYED.finditer(text):
                    a, b = match.span(1)
                    if not busy(a, b) and (a, b) not in found:
                        token = match.group(1)
                        found[a, b] = SECRET if looks_random(token) else None
                for (a, b), seed in sorted(found.items(), key=lambda x: x[0]):
                    token = text[a:b]
                    around = [{"pattern": p, "counted": c} for p, c in patterns_before(text, a, token, hashes)]
                    candidates.append((a, b, _signed(xxhash.xxh3_64_intdigest(token.encode())), seed, around))
                spans = taken
            all_spans.append([dict(zip(("start", "end", "kind"), s)) for s in spans])
            all_candidates.append([dict(zip(("start", "end", "instance", "seed", "patterns"), c)) for c in candidates])
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(c) for c in ("k1", "k2", "id")), pa.array(all_spans, pa.list_(span)), pa.array(all_candidates, pa.list_(candidate))],
            ["k1", "k2", "id", "base", "candidates"],
        )


class _Busy:
    """Whether a stretch meets one of some spans."""

    def __init__(self, spans: list[Span]):
        self.spans = sorted((a, b) for a, b, _ in spans)
        self.starts = [a for a, _ in self.spans]
        self.reach = []
        for _, b in self.spans:
            self.reach.append(max(b, self.reach[-1] if self.reach else 0))

    def __call__(self, start: int, end: int) -> bool:
        k = bisect_left(self.starts, end)
        return k > 0 and self.reach[k - 1] > start


def _occurrences(table: np.ndarray):
    """How often each word n-gram that the table may hold stands before another word."""
    mask = np.uint64((1 << _TABLE_BITS) - 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marked = np.unpackbits(table).astype(bool)
        hashes = word_hashes()
        for batch in pieces(batches, "text"):
            words = Words(texts_of(batch.column("text")), lower=True)
            codes = hashes.of(words.words)
            left = words.first[words.doc + 1] - np.arange(len(codes))
            found = []
            for n in range(1, CONTEXT_WORDS + 1):
                rolled = grams(codes, n)
                found.append(rolled[marked[rolled & mask] & (left[: len(rolled)] > n)])
            kinds, counts = np.unique(np.concatenate(found), return_counts=True)
            if len(kinds):
                yield pa.RecordBatch.from_arrays([pa.array(kinds.view(np.int64)), pa.array(counts)], ["pattern", "n"])

    return run


def _followers(table: np.ndarray):
    """Tokens behind a pattern that the table may hold, apart from base spans: (k1, k2, start, end, pattern)."""
    mask = np.uint64((1 << _TABLE_BITS) - 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marked = np.unpackbits(table).astype(bool)
        hashes = word_hashes()
        for batch in pieces(batches, "text"):
            texts = texts_of(batch.column("text"))
            words = Words(texts, lower=True)
            codes, doc = hashes.of(words.words), words.doc
            left = words.first[doc + 1] - np.arange(len(codes))
            found: dict[int, list[tuple[int, int, int]]] = {}  # of a text: start and end, in bytes, and pattern
            for n in range(1, CONTEXT_WORDS + 1):
                rolled = grams(codes, n)
                for at in np.flatnonzero(marked[rolled & mask] & (left[: len(rolled)] > n)).tolist():
                    k, word = int(doc[at]), at + n
                    start, end = int(words.start[word] - words.text_start[k]), int(words.end[word] - words.text_start[k])
                    token = texts[k][start:end]
                    start += len(token) - len(token.lstrip(_OPENING))
                    end = start + len(token.lstrip(_OPENING).rstrip(_CLOSING))
                    if end > start:
                        found.setdefault(k, []).append((start, end, int(rolled[at].view(np.int64))))
            rows = []
            for k, raw in enumerate(texts):
                keyed = b"=" in raw or b":" in raw
                if not keyed and k not in found:
                    continue
                text = raw.decode("utf-8", "replace")
                places = []
                if k in found:
                    upto = np.concatenate([[0], np.cumsum((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80)]).tolist()
                    places = [(upto[a], upto[b], p) for a, b, p in found[k]]
                for mark in _MARK.finditer(text) if keyed else ():
                    key = _NAME.search(text, max(0, mark.start() - 33), mark.start())
                    if key is None:
                        continue
                    pattern = xxhash.xxh3_64_intdigest(b"key " + key[1].lower().encode())
                    if marked[pattern & int(mask)] and (value := _VALUE.match(text, mark.end())):
                        token = value[1].rstrip(_CLOSING.decode())
                        if token:
                            places.append((value.start(1), value.start(1) + len(token), _signed(pattern)))
                if places:
                    busy = _Busy(base_spans(text))
                    rows += [(k, a, b, p) for a, b, p in places if not busy(a, b)]
            at, start, end, pattern = np.array(rows, np.int64).reshape(-1, 4).T
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c).take(pa.array(at)) for c in ("k1", "k2")), pa.array(start), pa.array(end), pa.array(pattern)],
                ["k1", "k2", "start", "end", "pattern"],
            )

    return run


def _table(patterns: DataFrame) -> np.ndarray:
    """Packed bits that tell which patterns there may be; at most 2 ** _TABLE_BITS places reach the driver."""
    places = patterns.select(F.col("pattern").bitwiseAND((1 << _TABLE_BITS) - 1).alias("place")).distinct()
    bits = np.zeros(1 << _TABLE_BITS, np.uint8)
    bits[places.toArrow().column("place").to_numpy()] = 1
    return np.packbits(bits)


_SCANNED = (
    "base array<struct<start:bigint,end:bigint,kind:string>>, candidates array<struct<start:bigint,end:bigint,"
    "instance:bigint,seed:string,patterns:array<struct<pattern:bigint,counted:boolean>>>>"
)


def find_personal_data(
    df: DataFrame, id_column: str = "doc_id", text_column: str = "text", *, support: int = SUPPORT,
    confidence: float = CONFIDENCE, turns: int = TURNS, background: DataFrame | None = None, staging: Staging | None = None,
) -> DataFrame:
    """One row per row of ``df``: the id, ``base`` and ``spans``, arrays of (start, end, kind) in code points, end exclusive, sorted.

    ``spans`` holds all of ``base`` and what the patterns add, which never overlaps base, and none of which lies inside another. A null text
    is empty and has none. Repeated rows are answered each, and count each as occurrences; a pattern needs ``support`` different seeds. ``background`` (default ``df``) are the texts in which words before anything are counted,
    where ``df`` leaves out texts without digits and marks. Other columns are not looked at.
    """
    staging = staging or Staging(df.sparkSession)
    # Two hashes of id and text name a row in both scans; repeated rows share them, as they do their spans.
    keys = [F.xxhash64(F.col(id_column), F.col(text_column), F.lit(i)).alias(f"k{i}") for i in (1, 2)]
    source = df.select(*keys, F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    kind = source.schema["id"].dataType.simpleString()
    scanned = staging.put(source.mapInArrow(_scan, f"k1 long, k2 long, id {kind}, {_SCANNED}"), "scanned")

    one = scanned.select("k1", "k2", F.explode("candidates").alias("c")).select("k1", "k2", "c.*")
    edges = one.select("start", "instance", "seed", F.explode("patterns").alias("p"))
    edges = edges.groupBy(F.col("p.pattern").alias("pattern"), F.col("p.counted").alias("counted"), "instance", "seed")
    edges = staging.put(edges.agg(F.count(F.lit(1)).alias("n")), "edges")

    resting = edges.where("seed is not null").groupBy("pattern", "counted", "seed").agg(F.count(F.lit(1)).alias("seeds"))
    resting = staging.put(resting.where(F.col("seeds") >= support), "patterns")
    corpus = df if background is None else background
    counted = corpus.select(F.col(text_column).alias("text")).mapInArrow(_occurrences(_table(resting.where("counted"))), "pattern long, n long")
    counted = counted.groupBy("pattern").agg(F.sum("n").alias("total"))

    live = edges.join(resting.select("pattern").distinct(), "pattern", "left_semi")
    totals = live.groupBy("pattern").agg(F.sum("n").alias("own")).join(counted, "pattern", "left")
    totals = staging.put(totals.select("pattern", F.greatest("own", F.coalesce("total", F.lit(0))).alias("total")), "totals")

    certain = live.where("seed is not null").select("instance", F.col("seed").alias("kind")).distinct()
    certain = certain.withColumn("score", F.lit(1.0))
    ties = staging.put(live.groupBy("pattern", "instance").agg(F.sum("n").alias("n")), "ties")
    scores = certain
    for turn in range(turns):
        judged = ties.join(scores, "instance").groupBy("pattern", "kind").agg(F.sum(F.col("n") * F.col("score")).alias("mass"))
        judged = judged.join(totals, "pattern").select("pattern", "kind", (F.col("mass") / (F.col("total") + 1)).alias("confidence"))
        judged = staging.put(judged.join(resting.select("pattern", F.col("seed").alias("kind")), ["pattern", "kind"], "left_semi"), "judged")
        if turn < turns - 1:
            unsure = ties.join(certain.select("instance"), "instance", "left_anti").join(judged, "pattern")
            doubt = F.sum(F.log1p(-F.least(F.col("confidence"), F.lit(0.999))))
            scores = certain.union(unsure.groupBy("instance", "kind").agg((1 - F.exp(doubt)).alias("score")))
    chosen = judged.where(F.col("confidence") >= confidence)

    marked = one.where(F.col("seed").isNull() | (F.col("seed") == SECRET))
    marked = marked.select("k1", "k2", "start", "end", F.explode("patterns.pattern").alias("pattern"))
    follow = source.select("k1", "k2", "text").mapInArrow(_followers(_table(chosen)), "k1 long, k2 long, start long, end long, pattern long")
    best = F.max(F.struct("confidence", "kind")).alias("best")
    added = marked.union(follow).join(chosen, "pattern").groupBy("k1", "k2", "start", "end").agg(best)
    # Of spans of one text those inside an earlier, or equally early and longer, one go.
    earlier = Window.partitionBy("k1", "k2").orderBy("start", F.desc("end")).rowsBetween(Window.unboundedPreceding, -1)
    added = added.withColumn("reach", F.max("end").over(earlier)).where("reach is null or end > reach").groupBy("k1", "k2")
    added = added.agg(F.collect_list(F.struct("start", "end", F.col("best.kind").alias("kind"))).alias("added"))
    joined = scanned.select("k1", "k2", "id", "base").join(added, ["k1", "k2"], "left")
    kept = F.coalesce("added", F.array().cast("array<struct<start:bigint,end:bigint,kind:string>>"))
    return joined.select(F.col("id").alias(id_column), "base", _sorted(F.concat("base", kept)).alias("spans"))


def _place(kind):
    return F.coalesce(F.nullif(F.array_position(F.array(*map(F.lit, BASE_KINDS)), kind), F.lit(0)), F.lit(len(BASE_KINDS) + 1))


def _sorted(spans):
    """By start, then kind as listed, kinds of other names last."""
    keyed = F.transform(spans, lambda s: F.struct(s["start"].alias("start"), _place(s["kind"]).alias("place"), s["end"].alias("end"), s["kind"].alias("kind")))
    return F.transform(F.array_sort(keyed), lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind")))


def spelled(spans):
    """``kind:start:end`` of each span, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def redact(text: str, spans: list[Span]) -> str:
    """The text with each span (overlapping ones merged) replaced by its kind in angle brackets."""
    out, last = [], 0
    for start, end, kind in sorted(spans):
        if end <= last:
            continue
        if start >= last:
            out += [text[last:start], f"<{kind.upper()}>"]
        last = end
    return "".join([*out, text[last:]])


def redacting(columns: tuple[str, ...], text_column: str = "text", spans_column: str = "spans"):
    """A function for ``mapInArrow``: the given columns, the text among them redacted."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(batch.column(text_column).to_pylist(), batch.column(spans_column).to_pylist())
            texts = [text and redact(text, [(s["start"], s["end"], s["kind"]) for s in spans or []]) for text, spans in rows]
            arrays = [pa.array(texts, pa.string()) if c == text_column else batch.column(c) for c in columns]
            yield pa.RecordBatch.from_arrays(arrays, list(columns))

    return run
