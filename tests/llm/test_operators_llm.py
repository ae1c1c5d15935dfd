"""Operators 2 to 9 against brute force, exact round trips and held-out rows."""

from __future__ import annotations

import hashlib
import itertools
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from llm_helpers import prose, word_list
from pyspark.sql import functions as F

from playlake.llm import chat, decontaminate, language, packing, queries, revisits, sharding, toxicity, winnowing
from playlake.llm import words as W
from playlake.llm.tokens import BatchEncoder

SF = "/root/testdata/sf0.001"
BPE = public_tokenizers.path("byte_bpe_50k.json")


# --- language identification


def brute_viterbi(s: np.ndarray, switch: float) -> float:
    best = s[0].copy()
    for row in s[1:]:
        best = np.maximum(best, best.max() - switch) + row
    return float(best.max())


def path_score(s: np.ndarray, label: np.ndarray, switch: float) -> float:
    return float(s[np.arange(len(s)), label].sum() - switch * (label[1:] != label[:-1]).sum())


def test_viterbi_finds_the_best_path():
    rng = np.random.default_rng(3)
    size = [0, 1, 7, 60, 0, 33, 2]
    first = np.concatenate([[0], np.cumsum(size)])
    s = rng.normal(0, 3, (first[-1], 4)) + np.repeat(rng.normal(0, 3, (first[-1] // 8 + 1, 4)), 8, 0)[: first[-1]]
    for switch in (0.5, 4.0, 15.0):
        label = language.viterbi(s, first, switch)
        for i, j in zip(first[:-1], first[1:]):
            if j > i:
                assert path_score(s[i:j], label[i:j], switch) == pytest.approx(brute_viterbi(s[i:j], switch))


def test_language_spans_und_and_scripts(spark):
    en = "the house and the garden with the old tree of that town " * 3
    de = "das haus und der garten mit dem alten baum der stadt ist " * 3
    ru = "дом и сад со старым деревом в этом городе " * 3
    train = spark.createDataFrame([(en, "en"), (de, "de"), (ru, "ru"), ("ignored", None), (None, "en")], "text string, lang string")
    model = language.fit(train)
    assert model.langs == ["de", "en", "ru"]
    texts = [en + de + ru, "das haus", "old town", "", None, "123 %%", "дом", "日本"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").withColumn("lang_pred", F.lit("clash"))
    rows = {r["doc_id"]: r for r in language.predict(docs.select("doc_id", "text"), model, ["doc_id"]).collect()}
    assert [s["lang"] for s in rows[0]["spans"]] == ["en", "de", "ru"]
    cut = [texts[0].encode()[s["start"] : s["end"]].decode() for s in rows[0]["spans"]]
    assert [c.strip() for c in cut] == [en.strip(), de.strip(), ru.strip()]
    assert [rows[i]["lang_pred"] for i in (1, 2, 3, 4, 5, 6)] == ["de", "en", "und", "und", "und", "ru"]
    assert all(0 <= r["score"] <= 1 for r in rows.values())
    none = language.fit(train.where("lang = 'xx'"))
    assert {r["lang_pred"] for r in language.predict(docs.select("doc_id", "text"), none, ["doc_id"]).collect()} == {"und"}


def test_language_held_out_accuracy(spark):
    out = queries.op2_language_id(spark, "/root/testdata/sf0.01").join(spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang"), "doc_id")
    held = out.where("held_out").select(F.avg((F.col("lang") == F.col("lang_pred")).cast("double"))).first()[0]
    assert out.count() == 1000 and held > 0.97


# --- toxicity


@pytest.fixture(scope="module")
def toxic_model(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    return queries.toxicity_model(spark, "/root/testdata/sf0.01", docs)


def test_viterbi_decode_equals_all_paths(toxic_model):
    logp = toxic_model.logp

    def score(word):
        x, y, s = 0, 0, 0.0
        for c in [*word, "\0"]:
            s += logp(x, y, ord(c))
            x, y = y, ord(c)
        return s

    for token in ("1d10t", "$tup1d", "m0r0n", "tr@5h", "haaat1on"):
        lattice = toxicity.readings(token)
        paths = ["".join(p) for p in itertools.product(*lattice)]
        got = toxicity.viterbi(lattice, logp)
        assert got in paths and score(got) == pytest.approx(max(map(score, paths)))
    assert toxicity.readings("plain") is None


def test_restore_changes_no_text_that_is_not_flagged():
    rng = random.Random(3)
    texts = ["as$", "a$$", "you dumba$$", "sh!+", "b!+(#", "s h * t", "a b c d", "ооо", "i—d", "a!.!.b", "5", "(5)", "plain words, \"quoted\" ones."]
    for alphabet in ("ab $!+(.\"", "aAiIsS  01$!@+(*<|._-~'/,;:?)]}[{\"#\n\x01\t", "aé€—\u00a0 оK²1$.!*\u0301", "ab .!, ", "a "):
        texts += ["".join(rng.choice(alphabet) for _ in range(rng.randrange(1, 14))) for _ in range(20_000)]
    flag = toxicity.disguised(W.word_batch([t.encode() for t in texts]))
    known: dict[str, str] = {}
    changed = [toxicity.restore(t, lambda a, b, c: -float(c), known) != t for t in texts]
    assert not [t for t, f, c in zip(texts, flag, changed) if c and not f]
    assert all(changed[:6]) and not flag[10] and not flag[12]


def test_stretched_look_alikes_and_short_separated_words(spark, toxic_model):
    for token, word in {"id1111ot": "idiot", "cl0000wn": "clown", "clo0own": "clown", "1d1i!0o0t": "idiot", "k111": "kill"}.items():
        for lattice in (toxicity.readings(token), toxicity.collapsed(token)):
            paths = {"".join(p) for p in itertools.product(*lattice)}
            assert toxicity.viterbi(lattice, toxic_model.logp) in paths
        both = paths | {"".join(p) for p in itertools.product(*toxicity.readings(token))}
        assert word in both, token
    assert toxicity.collapsed("idiooot") is None and toxicity.collapsed("1d10t") is None
    flat = lambda a, b, c: 0.0
    for text, word in {"a b c": "abc", "so 'a.b.c', or": "abc", "x a b c d.": "xabcd", "a @ b": "aab", "s h * t": "shut"}.items():
        assert word in toxicity.restore(text, flat, {}).split("\n")[1].split(), text
    clean = " ".join(["the thing and that erst"] * 8)
    texts = [f"{clean} {w} {clean}" for w in ("id1111ot", "idi0o0ot", "!!d!!!o0t", "i d i o t.")] + [clean]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    rows = {r["doc_id"]: r["predicted"] for r in toxicity.score(docs, toxic_model, ["doc_id"]).collect()}
    assert [rows[i] for i in range(5)] == [1, 1, 1, 1, 0]


def test_disguised_words_are_restored_and_scored(spark, toxic_model):
    clean = " ".join(["the thing and that erst"] * 8)
    texts = [f"{clean} {w} {clean}" for w in ("idiot", "1d10t", "i d i o t", "idiooooot", "i.d.i.o.t", "IDIOT")] + [clean, "", None, "%%%"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").withColumns({"top": F.lit(9.0), "marks": F.lit(9.0)})
    rows = {r["doc_id"]: r for r in toxicity.score(docs, toxic_model, ["doc_id"]).collect()}
    assert [rows[i]["predicted"] for i in range(10)] == [1] * 6 + [0] * 4
    assert len({rows[i]["score"] for i in (6, 7, 8, 9)}) == 1
    assert all(0 <= r["score"] <= 1 for r in rows.values())


def test_toxicity_held_out_and_no_labels(spark):
    sf = "/root/testdata/sf0.01"
    out = queries.op3_toxicity(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("held_out")
    assert out.where("toxic = 0 and predicted = 1").count() == 0
    assert out.where("toxic = 1").select(F.avg("predicted")).first()[0] > 0.7
    docs = spark.createDataFrame([(1, "a b")], "doc_id bigint, text string")
    model = toxicity.fit(docs, spark.createDataFrame([], "doc_id bigint, toxic int"))
    assert [r["predicted"] for r in toxicity.score(docs, model, ["doc_id"]).collect()] == [0]


# --- sharding


def brute_capacity(size, shards):
    low, high = max(size), sum(size)
    while low < high:
        mid = (low + high) // 2
        need, room = 1, mid
        for s in size:
            if s > room:
                need, room = need + 1, mid
            room -= s
        low, high = (mid + 1, high) if need > shards else (low, mid)
    return low


@pytest.mark.parametrize("bits", [2, 14])
def test_shards_equal_brute_force(spark, monkeypatch, bits):
    monkeypatch.setattr(sharding, "FIRST_BITS", bits)
    monkeypatch.setattr(sharding, "CELL_ROWS", 7)
    rng = random.Random(1)
    texts = ["x" * rng.randrange(1, 200) + str(i % 150) for i in range(400)] + ["hot"] * 200 + [None, "", ""]
    docs = spark.createDataFrame([(i if i % 50 else None, t) for i, t in enumerate(texts)], "doc_id bigint, text string").withColumn("key", F.lit(1))
    keyed = docs.select(F.xxhash64(F.coalesce("text", F.lit("")).cast("binary")).alias("k"), F.coalesce("text", F.lit("")).alias("t")).collect()
    groups: dict[int, int] = {}
    for r in keyed:
        groups[r["k"]] = groups.get(r["k"], 0) + len(r["t"]) + 8
    want = brute_capacity([groups[k] for k in sorted(groups)], 24)
    rows = sharding.shard(docs).collect()
    assert len(rows) == len(texts)
    total, slots, of = {}, {}, {}
    for r in rows:
        total[r["shard"]] = total.get(r["shard"], 0) + r["size"]
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert max(total.values()) == want and set(total) == set(range(len(total))) and len(total) <= 24
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert sorted((r["size"], r["text_crc32"]) for r in rows) == sorted((len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for t in texts)
    for r in rows:
        assert of.setdefault(r["text_crc32"], r["shard"]) == r["shard"]


def test_shards_of_few_rows(spark):
    assert sharding.shard(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0
    one = sharding.shard(spark.createDataFrame([(1, "a"), (2, "a")], "doc_id bigint, text string")).collect()
    assert sorted((r["shard"], r["slot"]) for r in one) == [(0, 0), (0, 1)]


# --- fingerprints


def test_winnowing_equals_brute_force(spark):
    texts = [" ".join(prose(1, 90, 9)), " ".join(prose(2, 18)), "a b", "", "one  TWO, three!", "x" * 4000, "日本語のテキスト。" * 30, "a " * 80]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    grams = winnowing.tokens(F.col("text"))
    base = docs.withColumn("t", grams)
    n = F.greatest(F.lit(1), F.size("t") - 4)
    base = base.withColumn("g", F.when(F.size("t") > 0, F.transform(F.sequence(F.lit(1), n), lambda i: F.pmod(F.xxhash64(F.slice("t", i, F.lit(5))), F.lit(1 << 32)))))
    want = {}
    for r in base.collect():
        h, chosen = r["g"] or [], []
        for i in range(max(1, len(h) - 15) if h else 0):
            window = list(enumerate(h))[i : i + 16]
            at = max(p for p, v in window if v == min(v for _, v in window))
            if not chosen or chosen[-1] != at:
                chosen.append(at)
        want[r["doc_id"]] = [(h[p], p) for p in sorted(set(chosen))]
    got = winnowing.add_fingerprint(docs, "text", "fp").collect()
    assert {r["doc_id"]: [(x["hash"], x["position"]) for x in r["fp"]] for r in got} == want


def test_op5_query_against_python(spark):
    rows = {r["doc_id"]: r for r in queries.op5_fingerprints(spark, SF).collect()}
    docs = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    ids = sorted(docs, reverse=True)
    for k, i in enumerate(ids):
        text, other = docs[i], docs[ids[(k + 1) % len(ids)]]
        third = len(text) // 3
        edited = text[: len(text) - third] + other[:third]
        assert rows[i]["n_chars"] == len(text) and rows[i]["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert 0 <= rows[i]["near_next"] <= 1 and 0 <= rows[i]["near_edited"] <= 1
    assert np.mean([r["near_edited"] for r in rows.values()]) > 0.4 > np.mean([r["near_next"] for r in rows.values()])


@pytest.mark.parametrize("ids", [[3, 1, 2, 9, 7], [5], [None, 4], [None], [2, 2, 1]])
def test_next_row_wraps_around(spark, ids):
    df = spark.createDataFrame([(i, f"t{k}") for k, i in enumerate(ids)], "doc_id bigint, text string")
    rows = winnowing.with_next(df, "doc_id", ["text"], blocks=4).collect()
    order = sorted(range(len(ids)), key=lambda k: (ids[k] is None, -(ids[k] or 0), f"t{k}"))
    want = {f"t{k}": f"t{order[(p + 1) % len(order)]}" for p, k in enumerate(order)}
    assert {r["text"]: r["__next"]["text"] for r in rows} == want


# --- chat formatting

RECORDS = [
    ('{"messages":[{"role":"user","content":"a"},{"role":"assistant","content":"b<|im_end|>"}]}', "messages", [("user", "a"), ("assistant", "b<|im_end|>")]),
    ('{"conversations":[{"from":"human","value":"a"},{"value":"b","from":"gpt"}]}', "conversations", [("user", "a"), ("assistant", "b")]),
    ('{"prompt":"p","completion":"<\\\\|x<"}', "prompt", [("user", "p"), ("assistant", "<\\|x<")]),
    ('{"instruction":"i","output":"o"}', "instruction", [("user", "i"), ("assistant", "o")]),
    ('{"system":"s","instruction":"i","output":""}', "system_instruction", [("system", "s"), ("user", "i"), ("assistant", "")]),
    ('{"instruction":"i","input":"x","output":"o"}', "instruction_input", [("user", "i\n\nx"), ("assistant", "o")]),
    ('{"messages":[{"role":"a\\nb\\\\n","content":"|>"},{"role":"","content":null}]}', "messages", [("a\nb\\n", "|>"), ("", "")]),
    ('{"other":1}', "unknown", []),
    ("[1]", "unknown", []),
    ("not json", "unknown", []),
    (None, "unknown", []),
]


def test_chat_layouts_and_round_trip(spark):
    df = spark.createDataFrame([(i, r) for i, (r, _, _) in enumerate(RECORDS)], "id int, record string")
    out = chat.render(chat.canonical(df)).withColumn("back", chat.read_turns("formatted")).withColumn("target", chat.read_loss("formatted", "loss"))
    rows = {r["id"]: r for r in out.collect()}
    for i, (_, layout, turns) in enumerate(RECORDS):
        r = rows[i]
        assert r["layout"] == layout
        assert [(t["role"], t["text"]) for t in r["turns"]] == turns == [(t["role"], t["text"]) for t in r["back"]]
        assert r["target"] == "".join(t for role, t in turns if role == "assistant")
        assert r["formatted"].count("<|") == 2 * len(turns)


def test_chat_order_of_keys_does_not_matter(spark):
    df = spark.createDataFrame([('{"completion":"c","prompt":"p"}',), ('{"prompt":"p","completion":"c"}',)], "record string")
    assert len({(r["layout"], r["fingerprint"]) for r in chat.canonical(df).collect()}) == 1


# --- decontamination


def brute_hits(text, items, n=10):
    w, hit, found = word_list(text), set(), set()
    for item, t in items:
        x = word_list(t)
        size = min(n, len(x))
        wins = {tuple(x[i : i + size]) for i in range(len(x) - size + 1)} if x else set()
        for i in range(len(w) - size + 1):
            if size and tuple(w[i : i + size]) in wins:
                hit.update(range(i, i + size))
                found.add(str(item))
    return sorted(hit), sorted(found)


def test_hits_and_cuts_equal_brute_force(spark):
    passage = prose(4, 40, 50)
    items = [(1, " ".join(passage)), (2, "Short ITEM, here"), (3, ""), (4, None), (10, " ".join(passage[:12])), (5, " ".join(prose(77, 30)))]
    own = [" ".join(prose(60 + i, 60, 50)) for i in range(3)]
    texts = [
        f"{own[0]}, {', '.join(passage[3:17])}. {own[1]}", f"short item   HERE {own[2]} É", own[0], "", None, "short item", " ".join(passage),
        f"...{' '.join(passage[:10])}...\n{own[2]} short-item-here!",
    ]
    docs = spark.createDataFrame([*enumerate(texts), (0, texts[0])], "doc_id bigint, text string").withColumns({"k": F.lit(1), "size": F.lit(2), "hash": F.lit(3)})
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    for r in decontaminate.find_hits(docs, bench).collect():
        hit, found = brute_hits(r["text"], items)
        assert (r["__n_words"], r["__hit"], r["__items"]) == (len(word_list(r["text"])), hit, found)
    out = decontaminate.decontaminate(docs, bench)
    assert out.columns == docs.columns
    for r in out.collect():
        hit, _ = brute_hits(texts[r["doc_id"]], items)
        assert word_list(r["text"]) == [w for i, w in enumerate(word_list(texts[r["doc_id"]])) if i not in hit]
    assert {r["doc_id"] for r in out.collect()} == {0, 1, 2, 3, 4, 5, 7}
    assert {r["doc_id"] for r in decontaminate.decontaminate(docs, bench, mode="documents").collect()} == {2, 3, 4, 5}
    assert decontaminate.find_hits(docs, bench.where("item_id > 99")).where("size(__hit) > 0").count() == 0
    assert decontaminate.find_hits(docs.where("doc_id > 99"), bench).count() == 0


def test_large_benchmark_takes_the_other_join(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "MAX_BROADCAST_WINDOWS", 0)
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    items = [(r["item_id"], r["text"]) for r in bench.collect()]
    for r in decontaminate.find_hits(docs, bench).collect():
        assert (r["__hit"], r["__items"]) == brute_hits(r["text"], items)


# --- packing


def test_encoder_equals_tokenizers():
    rng = random.Random(2)
    chars = [*"ab's re've'll'd''t  \n\n\t ,.!' é中文字1२ 😀ßΩ　", "<|endoftext|>", "'s", "'re", " '", "​", "͸"]
    texts = ["".join(rng.choice(chars) for _ in range(rng.randint(0, 30))) for _ in range(3000)] + [""]
    e = BatchEncoder(BPE)
    for got in (e.encode(texts), e.encode(texts)):
        assert [g.tolist() for g in got] == [e.whole.encode(t, add_special_tokens=False).ids for t in texts]


def test_pieces_and_places_are_exact(spark):
    texts = [" ".join(prose(i, 40 * i)) for i in range(40)] + ["", None, "a", "a"]
    docs = spark.createDataFrame([*enumerate(texts), (None, "no id")], "doc_id bigint, text string").withColumns({"id": F.lit(1), "cell": F.lit(2)})
    rows = packing.pack_documents(docs, BPE, window=256).collect()
    e = BatchEncoder(BPE)
    by_doc, by_seq = {}, {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_seq.setdefault(r["sequence_id"], []).append(r)
    for i, t in [*enumerate(texts), (None, "no id")]:
        ids = np.array([*e.whole.encode(t or "", add_special_tokens=False).ids, 1], "<u4")
        at = 0
        for r in sorted(by_doc.pop(i), key=lambda r: r["start"]):
            piece = ids[at : at + r["length"]]
            assert (r["start"], r["ids_crc32"], r["doc_tokens"]) == (at, zlib.crc32(piece.tobytes()), len(ids))
            at += r["length"]
        assert at == len(ids)
    assert not by_doc
    for s in by_seq.values():
        at = 0
        for r in sorted(s, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= 256
    used = sum(r["length"] for r in rows)
    assert used / (256 * len(by_seq)) > 0.9
    assert packing.pack_documents(docs.where("doc_id > 999"), BPE).count() == 0


def test_plan_places_every_piece():
    rng = np.random.default_rng(1)
    hist = np.bincount(np.minimum(2048, rng.exponential(600, 20_000).astype(int) + 1), minlength=2049)
    plan = packing.plan(hist)
    used = np.zeros(2049, np.int64)
    for pattern, count in plan:
        assert sum(n * t for n, t in pattern) <= 2048
        for n, t in pattern:
            used[n] += n * 0 + t * count
    assert (used == hist).all()
    assert (hist * np.arange(2049)).sum() / 2048 / sum(c for _, c in plan) > 0.995


def test_least_squares_reaches_an_exact_solution():
    columns = [((3, 1), (5, 1)), ((4, 2),), ((2, 1), (3, 2))]
    hist = np.zeros(9, np.int64)
    for c, x in zip(columns, (4, 7, 3)):
        for n, t in c:
            hist[n] += t * x
    assert packing.nnls(columns, hist, 500) == pytest.approx([4, 7, 3], abs=0.1)


# --- revisits


def test_revisits_equal_brute_force(spark):
    rng = random.Random(5)
    urls = ["http://www.A.org/x/?b=2&a=1#f", "https://a.org:443/x?a=1&b=2&utm_source=z", "a.org/x?a=1&b=2", "http://b.org", "http://b.org/", None]
    rows = []
    for i in range(300):
        kind = rng.choice(["response", "revisit", "revisit", "other"])
        tag, day = rng.choice([None, "t1", "t2", "W/t1"]), rng.choice([None, "d1", "d2"])
        rows.append((i, rng.choice(urls), rng.choice([None, *range(40)]), kind, tag, day, {"etag": tag or "", "server": f"s{i}", "date": f"n{i}"} if i % 9 else None))
    schema = "capture_id bigint, url string, ts bigint, kind string, etag string, last_modified string, headers map<string,string>"
    df = spark.createDataFrame(rows, schema).withColumns({"part": F.lit(1), "full": F.lit(2), "found": F.lit(3)})
    name = {u: "a.org/x?a=1&b=2" if u and "org/x" in u.lower() or u and ":443" in u else "b.org" for u in urls}
    got = {r["capture_id"]: r for r in revisits.resolve(df, slices=8).collect()}
    want = {r[0] for r in rows if r[3] == "revisit" and r[2] is not None}
    assert set(got) == want
    weak = lambda t: t.removeprefix("W/") if t else None
    for i, url, ts, kind, tag, day, headers in rows:
        if i not in want:
            continue
        earlier = [r for r in rows if r[3] == "response" and r[2] is not None and r[2] < ts and url and r[1] and name[r[1]] == name[url]]
        base = max(earlier, key=lambda r: (r[2], r[0]), default=None)
        if base is None:
            status = "no_response"
        elif tag and base[4]:
            status = "resolved" if weak(tag) == weak(base[4]) else "mismatch"
        elif day and base[5]:
            status = "resolved" if day == base[5] else "mismatch"
        else:
            status = "unchecked"
        own = headers or {}
        merged = {**(base[6] or {}), **{k: v for k, v in own.items() if k in revisits.PERMITTED}} if status in ("resolved", "unchecked") else own
        assert (got[i]["status"], got[i]["headers"]) == (status, merged)
        assert got[i]["resolved_id"] == (base[0] if status in ("resolved", "unchecked") else None)


def test_revisits_of_nothing(spark):
    schema = "capture_id bigint, url string, ts bigint, kind string, etag string, last_modified string, headers map<string,string>"
    assert revisits.resolve(spark.createDataFrame([], schema)).count() == 0


def test_toxicity_takes_any_id_and_label_type(spark):
    from playlake.llm import toxicity

    bad, good = "you are a wretched idiot and a stupid clown", "the garden is full of flowers and light"
    texts = [(f"d{i}", (bad if i % 2 else good) + f" w{i % 7}") for i in range(80)]
    docs = spark.createDataFrame(texts, "doc_id string, text string").selectExpr("*", "1.5 AS score", "'x' AS top", "7.0 AS predicted", "2 AS marks", "3 AS __text")
    labels = spark.createDataFrame([(f"d{i}", i % 2) for i in range(60)], "doc_id string, toxic bigint")
    model = toxicity.fit(docs, labels)
    kept = toxicity.keep_clean(docs, model)
    assert kept.columns == docs.columns
    rows = kept.collect()
    assert {r["doc_id"] for r in rows} == {f"d{i}" for i in range(0, 80, 2)}
    assert all((float(r["score"]), r["top"], float(r["predicted"]), r["marks"], r["__text"]) == (1.5, "x", 7.0, 2, 3) for r in rows)
    with pytest.raises(ValueError):
        toxicity.score(docs, model, docs.columns)
    assert toxicity.score(docs, model, ["doc_id", "top"]).count() == 80


def test_fingerprint_order_takes_string_ids(spark):
    from playlake.llm import winnowing

    ids = [f"k{i:04d}" for i in range(3000)]
    df = spark.createDataFrame([(i, f"t{i}") for i in ids] + [(None, "null")], "id string, text string")
    got = {r["id"]: r["__next"]["text"] for r in winnowing.with_next(df, "id", ["text"]).collect()}
    want = {ids[i]: f"t{ids[i - 1]}" for i in range(1, 3000)} | {"k0000": "null", None: "tk2999"}
    assert got == want


@pytest.mark.parametrize(
    ("record", "layout", "turns"),
    [
        ({"prompt": "p", "completion": "c", "id": 7, "tags": ["x"]}, "prompt", [("user", "p"), ("assistant", "c")]),
        ({"system": "s", "messages": [{"role": "user", "content": "u", "name": "n"}]}, "messages", [("system", "s"), ("user", "u")]),
        ({"system": "s", "conversations": [{"from": "gpt", "value": "v", "weight": 1}]}, "conversations", [("system", "s"), ("assistant", "v")]),
        ({"messages": []}, "no_messages", []),
        ({"system": "s", "instruction": "i", "input": "", "output": "o"}, "instruction_input", [("system", "s"), ("user", "i"), ("assistant", "o")]),
        ({"text": "free"}, "unknown", []),
        ({"prompt": "p"}, "unknown", []),
    ],
)
def test_layouts_allow_further_fields(spark, record, layout, turns):
    import json

    from playlake.llm import chat

    rows = spark.createDataFrame([(json.dumps(record), "kept")], "record string, r string")
    out = chat.canonical(rows)
    r = out.first()
    assert (r["layout"], [tuple(t) for t in r["turns"]], r["r"]) == (layout, turns, "kept")
    assert chat.unmapped(out).count() == (layout == "unknown")
