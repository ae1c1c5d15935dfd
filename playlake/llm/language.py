"""Language identification of mixed-language text (operator 2).

Each word is scored under every learned language by its hashed byte trigrams and its
whole form; the script of its letters narrows the languages that may stand for it.  A
Viterbi search over the words, with a penalty for each switch of language, labels spans.
The language with the most bytes of words is the document's.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playlake.llm import words as W
from playlake.llm.common import ship

#: Hashed features of a language's model, whatever the size of the corpus.
BUCKETS = 1 << 16
#: Cost of a switch of language between two words, in nats.
SWITCH = 12.0
#: Share of a language's words that must be in a script for it to be a candidate there.
SCRIPT_SHARE = 0.002
#: Log-probability that a word loses for each language that its script rules out.
RULED_OUT = -60.0

# First code points of script ranges and their scripts.
SCRIPT_STARTS = (
    (0x0000, "Latin"), (0x0370, "Greek"), (0x0400, "Cyrillic"), (0x0530, "Armenian"), (0x0590, "Hebrew"),
    (0x0600, "Arabic"), (0x0900, "Devanagari"), (0x0980, "Bengali"), (0x0A00, "Indic"), (0x0E00, "Thai"),
    (0x0F00, "Tibetan"), (0x1000, "Burmese"), (0x10A0, "Georgian"), (0x1100, "Hangul"), (0x1200, "Ethiopic"),
    (0x1E00, "Latin"), (0x1F00, "Greek"), (0x2000, "Common"), (0x3040, "Kana"), (0x3100, "Han"),
    (0xAC00, "Hangul"), (0xD7B0, "Common"), (0xF900, "Han"), (0xFB00, "Common"), (0x20000, "Han"),
)
SCRIPTS = tuple(dict.fromkeys(s for _, s in SCRIPT_STARTS))
_START = np.array([s for s, _ in SCRIPT_STARTS])
_KIND = np.array([SCRIPTS.index(s) for _, s in SCRIPT_STARTS])
UND = "und"


def scripts(b: W.Batch) -> np.ndarray:
    """Script of each word: that of its first character beyond ASCII, else Latin."""
    raw = b.raw.astype(np.int64)
    high = np.flatnonzero(b.raw >= 0xC0)
    first = np.searchsorted(high, b.start)
    at = high[np.minimum(first, len(high) - 1)] if len(high) else np.zeros(len(b.start), np.int64)
    some = (first < len(high)) & (at < b.end) if len(high) else np.zeros(len(b.start), bool)
    padded = np.concatenate([raw, np.zeros(4, np.int64)])
    x0, x1, x2, x3 = (padded[at + k] for k in range(4))
    two = (x0 & 0x1F) << 6 | (x1 & 0x3F)
    three = (x0 & 0x0F) << 12 | (x1 & 0x3F) << 6 | (x2 & 0x3F)
    four = (x0 & 0x07) << 18 | (x1 & 0x3F) << 12 | (x2 & 0x3F) << 6 | (x3 & 0x3F)
    code = np.where(x0 < 0xE0, two, np.where(x0 < 0xF0, three, four))
    return np.where(some, _KIND[np.searchsorted(_START, code, "right") - 1], 0)


def trigrams(b: W.Batch) -> np.ndarray:
    """Bucket of the byte trigram around each byte (of lower-cased words, separators are 0)."""
    low = np.concatenate([[0], W.WORD_BYTE[b.raw], [0]]).astype(np.int64)
    return ((low[:-2] * 65537 + low[1:-1] * 4099 + low[2:] * 131) * 40503 >> 4) & (BUCKETS - 1)


def form(b: W.Batch) -> np.ndarray:
    return (b.hash >> np.uint64(48)).astype(np.int64)


@dataclass
class Model:
    langs: list[str]
    grams: np.ndarray  # languages x BUCKETS: log-probabilities of trigrams
    forms: np.ndarray  # languages x BUCKETS: of whole words
    allowed: np.ndarray  # languages x scripts: 0 or RULED_OUT
    switch: float = SWITCH


def count_batches(langs: list[str]) -> Callable:
    """(language, kind, bucket, n): kind 0 counts trigrams, 1 whole words, 2 scripts."""
    at = {x: k for k, x in enumerate(langs)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(langs), 3, BUCKETS), np.int64)
        for batch in batches:
            own = np.array([at.get(x, -1) for x in batch.column(0).to_pylist()], np.int64)
            for i, j in W.chunks(batch.column(1)):
                b = W.word_batch([t or b"" for t in batch.column(1).slice(i, j - i).cast(pa.binary()).to_pylist()])
                tri, word, kind = trigrams(b), form(b), scripts(b)
                doc = np.repeat(np.arange(j - i), np.diff(b.first))
                byte_doc = np.repeat(np.arange(j - i), np.diff(b.at))
                inside = W.WORD_BYTE[b.raw] > 0
                for k in np.unique(own[i:j]):
                    w, y = own[i:j][doc] == k, (own[i:j][byte_doc] == k) & inside
                    total[k, 0] += np.bincount(tri[y], minlength=BUCKETS)
                    total[k, 1] += np.bincount(word[w], minlength=BUCKETS)
                    total[k, 2, : len(SCRIPTS)] += np.bincount(kind[w], minlength=len(SCRIPTS))
        k, kind, bucket = np.nonzero(total)
        cols = [pa.array(x) for x in (k, kind, bucket, total[k, kind, bucket])]
        yield pa.RecordBatch.from_arrays(cols, names=["k", "kind", "bucket", "n"])

    return run


def fit(docs: DataFrame, lang: str = "lang", text: str = "text", switch: float = SWITCH) -> Model:
    """Learn from all rows of ``docs`` whose language is not null.

    What reaches the driver are counts of BUCKETS features for each language, added up on
    the executors.  Without any labelled row the model has no language.
    """
    ship(docs.sparkSession)
    known = docs.where(F.col(lang).isNotNull()).select(F.col(lang).alias("lang"), F.col(text).alias("text"))
    langs = sorted(r["lang"] for r in known.select("lang").distinct().collect())  # one row per language
    counts = np.zeros((len(langs), 3, BUCKETS))
    if langs:
        rows = known.mapInArrow(count_batches(langs), "k bigint, kind bigint, bucket bigint, n bigint")
        got = rows.groupBy("k", "kind", "bucket").agg(F.sum("n").alias("n")).toArrow()
        k, kind, bucket, n = (got.column(c).to_numpy() for c in ("k", "kind", "bucket", "n"))
        counts[k, kind, bucket] = n
    logp = np.log((counts[:, :2] + 0.5) / (counts[:, :2].sum(2, keepdims=True) + 0.5 * BUCKETS))
    kinds = counts[:, 2, : len(SCRIPTS)]
    share = kinds / np.maximum(kinds.sum(1, keepdims=True), 1)
    allowed = share >= SCRIPT_SHARE
    allowed[:, ~allowed.any(0)] = True  # a script that no language was seen in narrows nothing
    return Model(langs, logp[:, 0], logp[:, 1], np.where(allowed, 0.0, RULED_OUT), switch)


def word_scores(b: W.Batch, m: Model) -> np.ndarray:
    """Score of each word under each language."""
    tri, word, kind = trigrams(b), form(b), scripts(b)
    out = np.empty((len(b.start), len(m.langs)))
    for k in range(len(m.langs)):
        total = np.concatenate([[0.0], np.cumsum(m.grams[k][tri])])
        out[:, k] = total[b.end] - total[b.start] + m.forms[k][word] + m.allowed[k][kind]
    return out


def viterbi(s: np.ndarray, first: np.ndarray, switch: float) -> np.ndarray:
    """Best language of each word; documents are the word ranges ``first``.

    A document stays in its best language if no stretch of words gains more by leaving it
    than one switch costs: then no path with a switch can be better.  The others are
    searched word by word, all documents of the batch at once.
    """
    docs, langs = len(first) - 1, s.shape[1]
    size = np.diff(first)
    doc = np.repeat(np.arange(docs), size)
    total = np.concatenate([np.zeros((1, langs)), np.cumsum(s, 0)])
    own = (total[first[1:]] - total[first[:-1]]).argmax(1)
    label = own[doc].astype(np.int64)
    if langs < 2 or not len(s):
        return label
    rest = s.copy()
    rest[np.arange(len(s)), label] = -np.inf
    gain = rest.max(1) - s[np.arange(len(s)), label]
    run = np.cumsum(gain)
    before = run - gain
    far = 4 * np.abs(run).max() + 1
    low = np.minimum.accumulate(before - doc * far) + doc * far
    leaves = np.zeros(docs, bool)
    leaves[doc[run - low > switch * 0.999]] = True
    todo = np.flatnonzero(leaves)
    todo = todo[np.argsort(-size[todo], kind="stable")]
    if not len(todo):
        return label
    back = np.zeros((len(s), langs), np.int16)
    v = s[first[todo]].copy()
    start = first[todo]
    active = np.searchsorted(-size[todo], -np.arange(1, size[todo[0]]), "left")  # documents longer than t words
    stay = np.arange(langs)
    for t in range(1, size[todo[0]]):
        n = active[t - 1]
        at = start[:n] + t
        top = v[:n].argmax(1)
        jump = v[np.arange(n), top] - switch
        leave = jump[:, None] > v[:n]
        back[at] = np.where(leave, top[:, None], stay)
        v[:n] = np.where(leave, jump[:, None], v[:n]) + s[at]
    now = v.argmax(1)
    end = size[todo] - 1
    for t in range(size[todo[0]] - 1, -1, -1):
        n = int(np.searchsorted(-end, -t, "right"))
        label[start[:n] + t] = now[:n]
        if t:
            now[:n] = back[start[:n] + t, now[:n]]
    return label


def has_letter(raw: list[bytes]) -> np.ndarray:
    def any_letter(t: bytes) -> bool:
        return any(c.isalpha() for c in t.decode("utf-8", "replace"))

    return np.fromiter((any_letter(t) for t in raw), bool, len(raw))


def predict_batches(model: object) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m: Model = model.value
        for batch in batches:
            text = batch.column(batch.num_columns - 1)
            for i, j in W.chunks(text):
                raw = [t or b"" for t in text.slice(i, j - i).cast(pa.binary()).to_pylist()]
                b = W.word_batch(raw)
                letter = has_letter(raw)
                label = viterbi(word_scores(b, m), b.first, m.switch) if m.langs else np.zeros(0, np.int64)
                doc = np.repeat(np.arange(j - i), np.diff(b.first))
                size = (b.end - b.start).astype(np.float64)
                langs = max(1, len(m.langs))
                mass = np.bincount(doc * langs + label, size, (j - i) * langs).reshape(-1, langs) if m.langs else np.zeros((j - i, 1))
                best = mass.argmax(1)
                pred = [m.langs[k] if letter[x] and m.langs else UND for x, k in enumerate(best)]
                share = np.where(letter, mass.max(1) / np.maximum(mass.sum(1), 1), 0.0)
                # spans: runs of one language, as offsets of words' bytes
                if len(label):
                    new = np.ones(len(label), bool)
                    new[1:] = (label[1:] != label[:-1]) | (doc[1:] != doc[:-1])
                    head = np.flatnonzero(new)
                    tail = np.concatenate([head[1:], [len(label)]]) - 1
                    base = b.at[doc[head]]
                    spans = pa.StructArray.from_arrays(
                        [pa.array(b.start[head] - base), pa.array(b.end[tail] - base), pa.array([m.langs[k] for k in label[head]])],
                        names=["start", "end", "lang"],
                    )
                    at = np.searchsorted(doc[head], np.arange(j - i + 1)).astype(np.int32)
                else:
                    spans = pa.array([], pa.struct([("start", pa.int64()), ("end", pa.int64()), ("lang", pa.string())]))
                    at = np.zeros(j - i + 1, np.int32)
                kept = [batch.column(k).slice(i, j - i) for k in range(batch.num_columns - 1)]
                yield pa.RecordBatch.from_arrays(
                    [*kept, pa.array(pred), pa.array(share), pa.ListArray.from_arrays(at, spans)],
                    names=[*batch.schema.names[:-1], "lang_pred", "score", "spans"],
                )

    return run


def predict(docs: DataFrame, model: Model, id_cols: list[str], text: str = "text") -> DataFrame:
    """id_cols, lang_pred, score and spans of each row of ``docs``.

    score is the share of the words' bytes that lie in spans of lang_pred.  spans are
    (start, end, lang), byte offsets into the UTF-8 text.  A text that is null or has no
    letter is ``und`` with score 0.  Other columns are ignored; repeated rows get equal results.
    """
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    src = docs.select(*id_cols, F.col(text).alias("__text"))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in src.schema.fields[:-1])
    return src.mapInArrow(predict_batches(shared), f"{kinds}, lang_pred string, score double, spans array<struct<start:bigint,end:bigint,lang:string>>")
