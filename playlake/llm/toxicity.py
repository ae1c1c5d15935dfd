"""Toxicity scores with noisy-channel deobfuscation (operator 3).

1. ``char_model``: counts of character trigrams inside words, over all documents.
2. ``restore``: tokens that look disguised (look-alike characters, letters spaced out
   or separated, stretched letters, masked vowels) become lattices of readings; Viterbi
   search under the character model picks the likeliest one.
3. ``fit``: words and word beginnings of the restored texts of labelled documents; those
   that mark toxic documents beyond chance get a weight, and a logistic curve turns a
   document's strongest weight and number of marks into a probability.
4. ``score``: every whole text, restored and scored by the same code.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from playlake.llm import words as W
from playlake.llm.common import lean, ship

# Look-alike characters and the letters that they stand for.
LOOKALIKE = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "<": "c", "€": "e", "*": "aeiou",
}

#: Buckets of the character model's hashed trigrams and of their contexts.
BUCKETS = 1 << 18
#: Labelled documents to learn from, at most: toxic and other ones, chosen by a hash of the id.
MAX_TOXIC, MAX_OTHER = 5_000, 20_000
#: Word beginnings that count as features, in bytes.
PREFIXES = (4, 5, 6)
#: Chance that any feature is picked wrongly, and documents that must have it at least.
ALPHA, LEAST_DOCS = 0.01, 3
CUTOFF = 0.7


def bucket(a, b, c):  # noqa: ANN001, ANN201  integers or arrays of them
    return ((a * 73856093) ^ (b * 19349663) ^ (c * 83492791)) & (BUCKETS - 1)


def trigram_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Bucket counts of character trigrams of words (with two marks before, one after); bucket
    numbers from BUCKETS on count the contexts."""
    total = np.zeros(2 * BUCKETS, np.int64)
    for batch in batches:
        for i, j in W.chunks(batch.column(0)):
            text = " ".join(t for t in batch.column(0).slice(i, j - i).to_pylist() if t).lower()
            code = np.frombuffer(f"  {text} ".encode("utf-32-le", "replace"), np.uint32).astype(np.int64)
            letter = LETTER[np.minimum(code, len(LETTER) - 1)]
            code = np.where(letter, code, 0)
            a, b, c = code[:-2], code[1:-1], code[2:]
            use = (b > 0) | (c > 0)
            a, b, c = np.where(b > 0, a, 0)[use], b[use], c[use]
            total[:BUCKETS] += np.bincount(bucket(a, b, c), minlength=BUCKETS)
            total[BUCKETS:] += np.bincount(bucket(a, b, 0), minlength=BUCKETS)
    some = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["bucket", "n"])


def _letters() -> np.ndarray:
    t = np.zeros(0x3000, bool)
    for c in range(len(t) - 1):
        t[c] = chr(c).isalpha()
    t[-1] = True  # beyond: ideographs and other letters
    return t


LETTER = _letters()


def char_model(docs: DataFrame, text: str = "text") -> np.ndarray:
    """Log-probabilities of BUCKETS hashed trigrams, from all documents."""
    ship(docs.sparkSession)
    rows = docs.select(text).mapInArrow(lean(trigram_batches), "bucket bigint, n bigint").groupBy("bucket").agg(F.sum("n").alias("n"))
    got = rows.toArrow()  # 2 * BUCKETS rows at most
    n = np.zeros(2 * BUCKETS)
    n[got.column("bucket").to_numpy()] = got.column("n").to_numpy()
    return n


@dataclass
class Model:
    chars: np.ndarray  # trigram and context counts
    feature: np.ndarray  # sorted hashes
    weight: np.ndarray
    curve: np.ndarray  # of (1, strongest weight, log(1 + marks))

    def logp(self, a: int, b: int, c: int) -> float:
        return float(np.log((self.chars[bucket(a, b, c)] + 0.1) / (self.chars[BUCKETS + bucket(a, b, 0)] + 4.0)))


OUTER = " \t\r\n.,;:?!\"')]}([{"
#: What is stripped before a token: no look-alikes.
LEAD = " \t\r\n.,;:?\"'[{"
SEPARATED = re.compile(r"(?<![^\s.,;:?!\"')\]}(\[{])(?:\S[ ._\-*~]){2,}\S(?![^\s.,;:?!\"')\]}(\[{])")
TOKEN = re.compile(r"\S+")
STRETCHED = re.compile(r"([^\W\d_])\1\1")
INNER = re.compile(r"(?<=\w)[._\-~'/]+(?=\w)")


def readings(token: str) -> list[list[str]] | None:
    """The lattice of a token: for each place the strings that may stand there; None if it is plain."""
    plain = True
    places: list[list[str]] = []
    i, n = 0, len(token)
    while i < n:
        c = token[i]
        j = i + 1
        while j < n and token[j] == c:
            j += 1
        if c.isalpha():
            if j - i >= 3:
                places.append([c, c + c])
                plain = False
            else:
                places += [[c]] * (j - i)
        elif c in LOOKALIKE:
            places += [list(LOOKALIKE[c])] * (j - i)
            plain = False
        else:
            plain = False
        i = j
    return None if plain or not places else places


def letters(c: str) -> frozenset[str]:
    """The letters that a character may stand for."""
    return frozenset(LOOKALIKE.get(c) or (c if c.isalpha() else ""))


def collapsed(token: str) -> list[list[str]] | None:
    """The lattice of a token in which each run that holds a look-alike, and whose characters may all
    stand for one letter, is that letter once or twice; None if it has no such run.

    It stands beside ``readings``, which reads each look-alike by itself: '111' may be 'ill' or a long 'i'.
    """
    some = False
    places: list[list[str]] = []
    i, n = 0, len(token)
    while i < n:
        same, j = letters(token[i]), i + 1
        while j < n and same & letters(token[j]):
            same, j = same & letters(token[j]), j + 1
        run, i = token[i:j], j
        if len(run) >= 2 and not run.isalpha():
            places.append([x for c in sorted(same) for x in (c, c + c)])
            some = True
        elif len(run) >= 3:
            places.append([run[0], run[0] * 2])
        else:
            places += [sorted(letters(c)) for c in run if letters(c)]
    return places if some else None


def viterbi(places: list[list[str]], logp: Callable[[int, int, int], float]) -> str:
    """The likeliest path through a lattice; between equal ones the first in character order."""
    best: dict[tuple[int, int], tuple[float, str]] = {(0, 0): (0.0, "")}
    for options in places:
        new: dict[tuple[int, int], tuple[float, str]] = {}
        for (a, b), (score, path) in best.items():
            for option in options:
                x, y, s = a, b, score
                for c in option:
                    s += logp(x, y, ord(c))
                    x, y = y, ord(c)
                old = new.get((x, y))
                if old is None or (s, old[1]) > (old[0], path + option):
                    new[x, y] = (s, path + option)
        best = new
    return max(((s + logp(a, b, 0), p) for (a, b), (s, p) in best.items()), key=lambda t: (t[0], t[1]))[1]


def restore(text: str, logp: Callable[[int, int, int], float], known: dict[str, str]) -> str:
    """The text, followed by the likeliest readings of its disguised tokens."""
    low = text.lower()
    found = []
    for m in SEPARATED.finditer(low):
        every = re.sub(r"[._\-~]", "", m.group()[::2])  # a star may separate letters or stand for one
        bare = re.sub(r"[ ._\-*~]", "", m.group())
        found += [every] if every == bare or m.group()[1] == "*" else [every, bare]
    for m in TOKEN.finditer(low):
        t = INNER.sub("", m.group().rstrip(OUTER).lstrip(LEAD))
        if t and (not t.isalpha() or t != m.group().strip(OUTER) or STRETCHED.search(t)):
            found.append(t)
    out = []
    for t in found:
        t = t.rstrip(OUTER).lstrip(LEAD)
        if len(t) < 2:  # no word
            continue
        word = known.get(t)
        if word is None:
            lattice = readings(t)
            word = viterbi(lattice, logp) if lattice else t if t.isalpha() else ""
            if short := collapsed(t):
                word = " ".join(dict.fromkeys([word, viterbi(short, logp)]))
            if len(known) < 200_000:
                known[t] = word
        if word:
            out.append(word)
    return f"{text}\n{' '.join(out)}" if out else text


# Classes of bytes.  Characters beyond ASCII count as letters here; ``odd`` judges them.
_SPACE, _LETTER, _OUTER, _ODD = range(4)
_KIND = np.full(256, _ODD, np.uint8)
_KIND[[*range(9, 14), *range(28, 33)]] = _SPACE
_KIND[[*range(65, 91), *range(97, 123), *range(128, 256)]] = _LETTER
_KIND[[ord(c) for c in OUTER if not c.isspace()]] = _OUTER
_LEADS = np.zeros(256, bool)
_LEADS[[ord(c) for c in LEAD if not c.isspace()]] = True
ASCII = re.compile(r"[\x00-\x7F]+")


def odd(text: str) -> bool:
    """Whether a text has a character beyond ASCII that is no letter, or stretched or separated letters."""
    low = text.lower()
    rest = ASCII.sub("", low)
    return bool(rest and not rest.isalpha() or STRETCHED.search(low) or SEPARATED.search(low))


def disguised(b: W.Batch) -> np.ndarray:
    """Documents that may hold a disguised token: ``restore`` changes no other ones."""
    raw, n = b.raw, len(b.at) - 1
    if not n:
        return np.zeros(0, bool)
    kind, low = _KIND[raw], W.WORD_BYTE[raw]
    kind[b.at[1:] - 1] = _SPACE  # the zero byte after each document
    edge = np.array([_SPACE], np.uint8)
    before, after = np.concatenate([edge, kind[:-1]]), np.concatenate([kind[1:], edge])
    lead = np.concatenate([[False], _LEADS[raw[:-1]]])
    # a digit or symbol, unless it stands alone but for punctuation
    hit = (kind == _ODD) & ~(((before == _SPACE) | lead) & ((after == _SPACE) | (after == _OUTER)))
    # punctuation inside a token, or before it where it is not stripped
    hit |= (kind == _OUTER) & ((after == _LETTER) | (after == _ODD)) & ~(_LEADS[raw] & (before == _SPACE))
    # a full stop after a single character
    hit[2:-1] |= (raw[2:-1] == ord(".")) & (kind[1:-2] != _SPACE) & (kind[3:] != _SPACE) & ((kind[:-3] == _SPACE) | (kind[:-3] > _LETTER))
    hit[1:2] |= (raw[1:2] == ord(".")) & (kind[:1] != _SPACE)
    hit[2:] |= (kind[2:] == _LETTER) & (low[2:] == low[1:-1]) & (low[1:-1] == low[:-2])
    # three single characters between blanks; punctuation may stand around them
    if len(raw) > 4:
        first = (kind != _SPACE) & ((before == _SPACE) | (before == _OUTER)) & (after == _SPACE)
        middle = (kind != _SPACE) & (before == _SPACE) & (after == _SPACE)
        last = (kind != _SPACE) & (before == _SPACE) & ((after == _SPACE) | (after == _OUTER))
        hit[4:] |= first[:-4] & middle[2:-2] & last[4:]
    flag = np.add.reduceat(hit, b.at[:-1]) > 0
    beyond = np.add.reduceat(raw >= 128, b.at[:-1]) > 0
    for i in np.flatnonzero(beyond & ~flag):
        flag[i] = odd(raw[b.at[i] : b.at[i + 1] - 1].tobytes().decode("utf-8", "replace"))
    return flag


def restored_batch(raw: list[bytes], model: Model, known: dict[str, str]) -> W.Batch:
    b = W.word_batch(raw)
    flag = np.flatnonzero(disguised(b))
    if not len(flag):
        return b
    memo: dict[tuple[int, int, int], float] = {}

    def logp(x: int, y: int, z: int) -> float:
        p = memo.get((x, y, z))
        if p is None:
            p = memo[x, y, z] = model.logp(x, y, z)
        return p

    texts = list(raw)
    for i in flag:
        texts[i] = restore(raw[i].decode("utf-8", "replace"), logp, known).encode("utf-8", "replace")
    return W.word_batch(texts)


def features(b: W.Batch) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words and word beginnings, and the document of each."""
    doc = np.repeat(np.arange(len(b.first) - 1), np.diff(b.first))
    size = b.end - b.start
    out, of = [b.hash], [doc]
    for p in PREFIXES:
        use = size > p
        at = b.start[use]
        h = np.zeros(len(at), np.uint64)
        for k in range(p):
            h = h * np.uint64(0xC6A4A7935BD1E995) + W.WORD_BYTE[b.raw[at + k]].astype(np.uint64) + np.uint64(p)
        out.append(W.mix(h + np.uint64(p * 0x9E3779B97F4A7C15 % (1 << 64))))
        of.append(doc[use])
    return np.concatenate(out), np.concatenate(of)


def marks(h: np.ndarray, doc: np.ndarray, n: int, feature: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(document, index of feature) of the known features, each once for a document."""
    if not len(feature) or not len(h):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    seen = np.zeros(1 << 16, bool)
    seen[(feature >> np.uint64(48)).astype(np.int64)] = True
    pick = np.flatnonzero(seen[(h >> np.uint64(48)).astype(np.int64)])
    at = np.minimum(np.searchsorted(feature, h[pick]), len(feature) - 1)
    good = feature[at] == h[pick]
    cell = np.unique(doc[pick][good] * len(feature) + at[good])
    return cell // len(feature), cell % len(feature)


def toxic_features(model: object) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, str] = {}
        for batch in batches:
            for i, j in W.chunks(batch.column(0)):
                b = restored_batch(batch.column(0).slice(i, j - i).cast(pa.binary()).to_pylist(), model.value, known)
                h, doc = features(b)
                order = np.lexsort((doc, h))
                h, doc = h[order], doc[order]
                first = np.ones(len(h), bool)
                first[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
                value, n = np.unique(h[first], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(value.view(np.int64)), pa.array(n)], names=["feature", "n"])

    return run


def marked_documents(model: object) -> Callable:
    """Columns but the last (text), strongest weight and number of marks; with no weights yet, the marks' indexes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, known = model.value, {}
        for batch in batches:
            text = batch.column(batch.num_columns - 1)
            for i, j in W.chunks(text):
                b = restored_batch([t or b"" for t in text.slice(i, j - i).cast(pa.binary()).to_pylist()], m, known)
                h, doc = features(b)
                doc, f = marks(h, doc, j - i, m.feature)
                kept = [batch.column(k).slice(i, j - i) for k in range(batch.num_columns - 1)]
                if not len(m.weight):
                    at = np.searchsorted(doc, np.arange(j - i + 1)).astype(np.int32)
                    yield pa.RecordBatch.from_arrays([*kept, pa.ListArray.from_arrays(at, f)], names=[*batch.schema.names[:-1], "f"])
                    continue
                top = np.zeros(j - i)
                np.maximum.at(top, doc, m.weight[f])
                count = np.bincount(doc, minlength=j - i).astype(np.float64)
                yield pa.RecordBatch.from_arrays([*kept, pa.array(top), pa.array(count)], names=[*batch.schema.names[:-1], "top", "marks"])

    return run


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2) -> np.ndarray:
    """Newton's method for a logistic curve with a small ridge (the data may be separable)."""
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        g = x.T @ (p - y) + ridge * w
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w)), g)
        w -= np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return w


def fit(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
    max_toxic: int = MAX_TOXIC,
    max_other: int = MAX_OTHER,
) -> Model:
    """Learn from ``labels`` (id, label 0 or 1; other or null labels are ignored).

    The character model takes all of ``docs``.  The classifier takes at most about
    ``max_toxic`` and ``max_other`` labelled documents: a share of each class, by a hash
    of the id.  Without labelled documents of both kinds every score is the base rate.
    """
    spark: SparkSession = docs.sparkSession
    ship(spark)
    model = Model(char_model(docs, text), np.zeros(0, np.uint64), np.zeros(0), np.array([-3.0, 0.0, 0.0]))
    known = labels.where(F.col(label).isin(0, 1)).groupBy(F.col(id_col).alias("id")).agg(F.max(F.col(label).cast("int")).alias("y"))
    n = {r["y"]: r["n"] for r in known.groupBy("y").agg(F.count("*").alias("n")).collect()}
    n1, n0 = n.get(1, 0), n.get(0, 0)
    if not n1 or not n0:
        return model
    model.curve = np.array([np.log((n1 + 0.5) / (n0 + 0.5)), 0.0, 0.0])
    part = F.pmod(F.xxhash64("id"), F.lit(1_000_000))
    share = F.when(F.col("y") == 1, F.lit(max_toxic / n1)).otherwise(F.lit(max_other / n0))
    picked = known.where(part < share * 1_000_000)
    # about max_toxic + max_other rows of an id and a label: small for any table
    sample = docs.select(F.col(id_col).alias("id"), F.col(text).alias("text")).join(F.broadcast(picked), "id").where("text is not null")
    shared = spark.sparkContext.broadcast(model)
    counted = sample.where("y = 1").select("text").mapInArrow(lean(toxic_features(shared)), "feature bigint, n bigint")
    counted = counted.groupBy("feature").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST_DOCS)
    got = counted.toArrow()  # bounded by the sample: each row stands for LEAST_DOCS documents' words
    feature = got.column("feature").to_numpy().astype(np.int64).view(np.uint64)
    order = np.argsort(feature)
    feature, toxic = feature[order], got.column("n").to_numpy().astype(np.float64)[order]
    shared = spark.sparkContext.broadcast(Model(model.chars, feature, np.zeros(0), model.curve))
    rows = sample.select("y", "text").mapInArrow(lean(marked_documents(shared)), "y int, f array<bigint>")
    per = rows.groupBy("y").agg(F.count("*").alias("n")).collect()
    size = {r["y"]: r["n"] for r in per}
    other = rows.where("y = 0").select(F.explode("f").alias("f")).groupBy("f").agg(F.count("*").alias("n")).toArrow()
    clean = np.zeros(len(feature))
    clean[other.column("f").to_numpy()] = other.column("n").to_numpy()
    t, c = float(size.get(1, 0)), float(size.get(0, 0))
    if not t or not c or not len(feature):
        return model
    keep = g_test(toxic, clean, t, c) > 2 * np.log(max(len(feature), 1) / ALPHA)
    weight = np.log((toxic + 0.5) / (t + 1)) - np.log((clean + 0.5) / (c + 1))
    keep &= weight > 1.0
    model = Model(model.chars, feature[keep], weight[keep], model.curve)
    if not keep.any():
        return model
    shared = spark.sparkContext.broadcast(model)
    seen = sample.select("y", "text").mapInArrow(lean(marked_documents(shared)), "y int, top double, marks double").toArrow()
    y = seen.column("y").to_numpy().astype(np.float64)
    x = curve_input(seen.column("top").to_numpy(), seen.column("marks").to_numpy())
    # the sample's shares differ from the labels': shift the curve back to their odds
    shift = np.log((n1 / n0) / (t / c))
    curve = logistic(x, y)
    if curve[1:].min() < 0:  # more or stronger marks must not lower a score: the strongest alone decides
        curve = np.append(logistic(x[:, :2], y), 0.0)
    model.curve = curve + np.array([shift, 0.0, 0.0])
    return model


def g_test(toxic: np.ndarray, clean: np.ndarray, t: float, c: float) -> np.ndarray:
    """Log-likelihood ratio of a feature's share among toxic and other documents."""

    def part(k: np.ndarray, n: float, p: np.ndarray) -> np.ndarray:
        q = np.clip(p, 1e-12, 1 - 1e-12)
        return k * np.log(q) + (n - k) * np.log(1 - q)

    both = (toxic + clean) / (t + c)
    return 2 * (part(toxic, t, toxic / t) + part(clean, c, clean / c) - part(toxic, t, both) - part(clean, c, both))


def curve_input(top: np.ndarray, count: np.ndarray) -> np.ndarray:
    return np.stack([np.ones(len(top)), top, np.log1p(count)], 1)


def score(docs: DataFrame, model: Model, id_cols: list[str], text: str = "text") -> DataFrame:
    """id_cols, score (0 to 1) and predicted (1 from CUTOFF on) of each row of ``docs``.

    A null or empty text gets the score of a text without marks.  Rows that repeat get
    equal scores; other columns are ignored.  ``id_cols`` may hold any names but those two.
    """
    if {"score", "predicted"} & set(id_cols):
        raise ValueError("a column to keep has the name of a result")
    names, rows = _scored(docs, model, id_cols, text)
    return rows.select(*names, F.col("__score").alias("score"), (F.col("__score") >= CUTOFF).cast("int").alias("predicted"))


def keep_clean(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that are not predicted as toxic, with all their columns, whatever their names."""
    names, rows = _scored(docs, model, docs.columns, text)
    return rows.where(F.col("__score") < CUTOFF).select(*names)


def _scored(docs: DataFrame, model: Model, id_cols: list[str], text: str) -> tuple[list[Column], DataFrame]:
    """The columns ``id_cols`` of a frame with ``__score``, which holds them under names of its own."""
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    own = [f"__k{i}" for i in range(len(id_cols))]
    src = docs.select(*[F.col(f"`{c}`").alias(k) for c, k in zip(id_cols, own)], F.col(f"`{text}`").alias("__text"))
    kinds = "".join(f"{f.name} {f.dataType.simpleString()}, " for f in src.schema.fields[:-1])
    if not len(model.feature):
        rows = src.select(*own, F.lit(0.0).alias("top"), F.lit(0.0).alias("marks"))
    else:
        rows = src.mapInArrow(lean(marked_documents(shared)), f"{kinds}top double, marks double")
    a, b, c = (float(x) for x in model.curve)
    p = 1 / (1 + F.exp(-(F.lit(a) + F.lit(b) * F.col("top") + F.lit(c) * F.log1p("marks"))))
    return [F.col(k).alias(c) for c, k in zip(id_cols, own)], rows.select(*own, p.alias("__score"))
