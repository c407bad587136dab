"""Operators on texts against brute force, the tokenizers library and held-out accuracy; odd inputs."""

import hashlib
import random
import time
import zlib
from collections import Counter
from math import log10

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from carelint.llm import bpe, edits, langid, lm, mixing, sharding, simhash, suffixes
from carelint.llm.common import CLEANUP, TOKENIZER, components, tokenizer_path, written

PATH = tokenizer_path(TOKENIZER)
OPERATORS = {"op1": langid.op1, "op3": bpe.op3, "op4": suffixes.op4, "op5": edits.op5, "op7": lm.op7, "op8": mixing.op8, "op9": simhash.op9, "op10": sharding.op10}


@pytest.mark.parametrize("name", OPERATORS)
def test_odd_and_empty_tables(name, odd, none):
    rows = OPERATORS[name](odd).collect()
    assert len(rows) == odd.count()
    assert OPERATORS[name](none).count() == 0


@pytest.mark.parametrize("stage", [s for s, _ in corpus_pipeline.STAGES])
def test_stages_take_odd_and_empty_tables(spark, stage, odd, none):
    f = dict(corpus_pipeline.STAGES)[stage]
    got = f(spark, odd, "")
    if stage != corpus_pipeline.STAGES[-1][0]:
        assert got.schema.names == odd.schema.names
    assert 0 < got.count() <= odd.count() and f(spark, none, "").count() == 0


def test_language_is_found_in_held_out_documents(docs):
    got = langid.op1(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").select(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")), F.min("score"), F.max("score")).first()
    assert got[0] > 0.97 and 0 <= got[1] <= got[2] <= 1


def test_language_of_odd_texts(odd):
    got = {r.doc_id: (r.lang_pred, r.score) for r in langid.op1(odd).collect()}
    assert all(got[i] == ("und", 0.0) for i in (1, 2, 3, 4)) and got[6][0] in ("de", "en", "fr")


def test_word_score_sums_all_segmentations():
    v = langid.vocabulary(tokenizer_path("piece_bpe_32k.model"))
    rnd = np.random.default_rng(0)
    logp = np.log(rnd.dirichlet(np.ones(v.size), 2).T + 1e-12)
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path("piece_bpe_32k.model"))
    piece = {sp.id_to_piece(int(i)): int(i) for i in v.plain if len(sp.id_to_piece(int(i))) <= v.longest}

    def brute(s):
        if not s:
            return np.ones(2)
        total = np.zeros(2)
        for n in range(1, len(s) + 1):
            if s[:n] in piece:
                total += np.exp(logp[piece[s[:n]]]) * brute(s[n:])
            elif n == 1:
                total += np.prod([np.exp(logp[v.byte[b]]) for b in s[0].encode()], axis=0) * brute(s[1:])
        return total
    words = ["the", "unendlich", "naïve", "𝄞x", "a", "tion-ing"]
    want = np.log([brute("▁" + w) for w in words])
    assert np.allclose(langid.word_scores(v, logp, words), want)


def test_bpe_equals_the_library():
    from tokenizers import Tokenizer

    lib, own, rnd = Tokenizer.from_file(PATH), bpe.encoder(PATH), random.Random(1)
    texts = ["".join(rnd.choice(["a", "b", " ", "  ", "'s", "\n", "\t", "é", "1", "=", "tion", "ing", "表", "\x1c", " ", "<|endoftext|>"]) for _ in range(rnd.randint(0, 120))) for _ in range(1500)]
    texts += ["".join(rnd.choice("etaoinshr") for _ in range(rnd.randint(1, 60))) for _ in range(1500)] + ["a" * 5000, "-" * 777 + "=" * 999, " " * 300]
    for t in texts:
        ids = lib.encode(t, add_special_tokens=False).ids
        assert own.encode(t).tolist() == ids and own.decode(own.encode(t)) == lib.decode(ids, skip_special_tokens=False)


def test_bpe_round_trip(docs, odd):
    assert bpe.op3(docs).where("not round_trip").count() == 0
    back = bpe.decode(bpe.encode(odd))
    assert sorted(map(str, back.collect())) == sorted(map(str, odd.select("doc_id", F.coalesce("text", F.lit(""))).withColumnRenamed("coalesce(text, )", "text").collect()))


def brute_repeats(rows, length=100):
    seen, out = set(), {}
    for d, t in sorted(rows):
        b = (t or "").encode()
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            w = b[i : i + length]
            if w in seen:
                gone[i : i + length] = b"\1" * length
            seen.add(w)
        runs = sum(g and not p for g, p in zip(gone, b"\0" + bytes(gone)))
        out[d] = (len(b), sum(gone), runs, hashlib.sha256(bytes(x for x, g in zip(b, gone) if not g)).hexdigest())
    return out


@pytest.mark.parametrize("many, block", [(32, 48 << 20), (2, 3000)])
def test_repeats_equal_brute_force(spark, monkeypatch, many, block):
    rnd = random.Random(many)
    base = ["".join(rnd.choice("abcdefgh éü") for _ in range(rnd.choice([50, 99, 100, 101, 150, 300, 1000]))) for _ in range(25)]
    rows = [(1, None), (2, ""), (3, "a" * 350), (4, "ab" * 200), (5, "a" * 99), (6, "a" * 100)]
    for i in range(7, 150):
        parts = []
        for _ in range(rnd.randint(1, 4)):
            x, k = rnd.choice(base), rnd.random()
            a = rnd.randrange(len(x))
            parts.append(x[a : a + rnd.randint(1, 400)] if k < 0.4 else "".join(rnd.choice("abcdefgh ") for _ in range(rnd.randint(1, 300))) if k > 0.8 else x)
        rows.append((i, "".join(parts)))
    want = brute_repeats(rows)
    rnd.shuffle(rows)
    # The task functions by themselves, with their bounds lowered.
    import pandas as pd
    import pyarrow as pa
    monkeypatch.setattr(suffixes, "MANY", many)
    monkeypatch.setattr(suffixes, "BLOCK", block)
    batch = pa.RecordBatch.from_pydict({"doc_id": [d for d, _ in rows], "text": [(t or "").encode() for _, t in rows]})
    seeds = pd.concat([b.to_pandas() for b in suffixes._seeds(100, 32)(iter([batch]))])
    found = pd.concat([x for p in range(5) for x in suffixes._settle_seeds(100, 32)(iter([seeds[seeds["key"] % 5 == p]] if (seeds["key"] % 5 == p).any() else []))])
    texts, ask = dict(rows), found[~found["settled"]]
    asked = pd.DataFrame([{"doc_id": d, "text": texts[d].encode(), "ranges": g.to_dict("records")} for d, g in ask.groupby("doc")])
    windows = pd.concat(list(suffixes._windows(100)(iter([asked]))))
    late = pd.concat(list(suffixes._settle_windows(100)(iter([windows]))))
    spans = pd.concat([found[found["settled"]][["doc", "start", "end"]], late])
    for d, t in rows:
        b = (t or "").encode()
        s, e = suffixes.merged(spans[spans["doc"] == d].to_dict("records"), len(b))
        assert (len(b), int((e - s).sum()), len(s), hashlib.sha256(suffixes.kept_bytes(b, s, e)).hexdigest()) == want[d]
    got = {r[0]: tuple(r[1:]) for r in suffixes.op4(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)).collect()}
    assert got == want


def test_a_task_holds_little_more_than_the_anchors_of_its_texts():
    import tracemalloc

    import pyarrow as pa

    data = np.random.default_rng(3).integers(97, 123, 8 << 20, np.uint8).tobytes()
    texts = [data[at : at + 4096] for at in range(0, len(data), 4096)]
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(len(texts))), "text": texts})
    tracemalloc.start()
    try:
        sent = [b.num_rows for b in suffixes._seeds(100, 32)(iter([batch]))]
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert sum(sent) > len(data) / 50 and max(sent) <= suffixes.SENT
    assert peak < 8 * len(data)


def test_repeated_doc_ids_keep_their_first_copy(spark):
    rnd = random.Random(8)
    words = lambda n: "".join(rnd.choice("abcdefgh é") for _ in range(n))
    same, passage, other, third = words(400), words(150), words(300), words(200)
    # Row 3 copies a passage of the one document 1; the two documents 2 share a passage.
    rows = [(1, same), (1, same), (1, same), (2, passage + other), (2, third + passage), (3, "x" + same[:200]), (4, None), (4, None), (None, same), (None, same)]
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = Counter((r.doc_id, r.text) for r in suffixes.dedup(table).collect())
    assert got[1, same] == 3 and got[4, None] == 2 and got[None, same] == 2 and got[3, "x"] == 1
    own = {t for d, t in got if d == 2}
    assert own in ({passage + other, third}, {other, third + passage}) and sum(got.values()) == len(rows)
    removed = Counter((r.doc_id, r.n_bytes, r.n_removed) for r in suffixes.op4(table).collect())
    b = lambda x: len(x.encode())
    assert removed[1, b(same), 0] == 3 and removed[3, 1 + b(same[:200]), b(same[:200])] == 1
    assert sum(n for (d, _, gone), n in removed.items() if d == 2 and gone == 0) == 1 and sum(gone for d, _, gone in removed if d == 2) == b(passage)


def test_the_encoder_is_asked_once_for_a_short_pre_token(monkeypatch):
    asked = Counter()

    class Letters:
        def _piece(self, token):
            asked[token] += 1
            return b"\0\0\0\0" * len(token)

    monkeypatch.setattr(edits, "encoder", lambda path: Letters())
    monkeypatch.setattr(edits, "MEMO_SIZE", 2, raising=False)
    count, long = edits.counter(PATH), "x" * (bpe.MEMO_CHARS + 1)
    assert [count(["a", " bc", "a"]), count(["a", long, long]), count(["d", "a"])] == [5, 1 + 2 * len(long), 2]
    assert asked == {"a": 2, " bc": 1, long: 2, "d": 1}  # the limit of two is reached before d


def test_counts_follow_edits(spark):
    count, own, rnd = edits.counter(PATH), bpe.encoder(PATH), random.Random(5)
    text = lambda n: "".join(rnd.choice(["a", "the", " ", "  ", "\n", "'", "re", "s", "é", "12", ",", " tion"]) for _ in range(n))
    for k in range(300):
        now = text(rnd.choice([0, 1, 3, 50, 400, 3000]))
        doc = edits.Document.of(now, count)
        for _ in range(6):
            a, new = rnd.randint(0, len(now) + 2), text(rnd.choice([0, 0, 1, 5, 60, 900]))
            z = a + rnd.choice([0, 0, 1, 3, 40, 1000])
            doc.edit(a, z, new, count)
            now = now[:a] + new + now[max(min(a, len(now)), min(z, len(now))) :]
            assert doc.text == now and doc.tokens[1] == len(own.packed(now)) // 4 and doc.pieces[1] == len(own.split(now))
    state = edits.build(spark.createDataFrame([(1, "the cat " * 500), (2, None)], "doc_id long, text string"))
    got = {r.doc_id: r for r in edits.apply(state.withColumn("edits", F.expr(f"from_json('[{{\"start\":4,\"end\":7,\"text\":\"dog\"}}]', '{edits.EDITS}')"))).collect()}
    assert got[1].text.startswith("the dog the cat") and got[1].n_encoded < 100 and got[2].text == "dog"


def test_counts_of_the_query_equal_full_encoding(docs, odd):
    """Kept trees after their edits against encoding the edited texts from scratch."""
    own = bpe.encoder(PATH)
    for table in (docs, odd):
        want = Counter()
        for r in edits.sample_edits(table).select("doc_id", "text", "edits").collect():
            before = now = r.text or ""
            for e in r.edits:
                a = max(0, min(e.start, len(now)))
                now = now[:a] + e.text + now[max(a, min(e.end, len(now))) :]
            want[r.doc_id, len(own.packed(before)) // 4, len(own.packed(now)) // 4, len(own.split(now))] += 1
        assert Counter((r.doc_id, r.n_before, r.n_after, r.n_pieces) for r in edits.op5(table).collect()) == want


def test_lm_base_and_model(docs):
    rows = [(r.doc_id, (r.text or "").encode().lower().split() + [b""]) for r in docs.collect()]
    count = Counter(w for d, ws in rows if zlib.crc32(str(d).encode()) % 5 != 1 for w in ws)
    total, v = sum(count.values()), len(count)
    got = {r.doc_id: r for r in lm.op7(docs).collect()}
    for d, ws in rows:
        r = got[d]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(ws), sum(w in count for w in ws), total)
        assert abs(r.base_score - sum(log10((count[w] + 0.5) / (total + 0.5 * (v + 1))) for w in ws)) < 1e-6
    held = [r for r in got.values() if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_lm_is_a_distribution(spark):
    train = spark.createDataFrame([(i, f"the cat sat on w{i % 40} mat{i}") for i in range(200)], "doc_id long, text string")
    words = lm.word_counts(train)
    model = lm.trained(train, lm.counted(words, 60), 2)
    scorer = lm.Scorer(model)
    n = {bytes(r.word): r.n for r in words.collect()}
    # All tokens after one history, from the parts themselves.
    place, kind, head, h = scorer.reader.known([b"", *[w for w in n if w]])
    starts = np.array([0, 3])
    hashes = np.array([xxhash.xxh64_intdigest(w, 17) for w in (b"the", b"cat", b"sat")], np.uint64)
    rows, head_rows = lm.features(starts, hashes, np.array([2]))
    p = lm.softmax(lm.logits(model.weights, rows) + scorer.classes)[0]
    mass = np.zeros(lm.CLASSES)
    for c in range(lm.HEAD // lm.MEMBERS):
        part = model.inner[:, c * lm.MEMBERS : (c + 1) * lm.MEMBERS]
        mass[lm.FORMS + c] = lm.softmax(lm.logits(part, head_rows) + scorer.members[c])[0].sum()
    for w, k in zip([b"", *[w for w in n if w]], kind):
        if k < lm.FORMS:
            mass[k] += (n[w] + 0.5) / model.mass[k]
    mass[: lm.FORMS] += 0.5 / model.mass
    assert np.allclose(mass, 1, atol=1e-5) and abs(p.sum() - 1) < 1e-5


def test_lm_counts_words_without_a_row_for_each_token(spark, monkeypatch):
    texts = ["The THE the", None, "", " \t\x0b\f\r\n", "\u00c9t\u00e9 \u00c9T\u00c9\u00a0x a\x1cb \u2003 end", "a b c d e f a b c d e f"]
    want = Counter(w for t in texts for w in [*(t or "").encode().lower().split(), b""])
    monkeypatch.setattr(lm, "DISTINCT", 3)
    words = lm.word_counts(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    assert {bytes(r["word"]): r["n"] for r in words.collect()} == want
    assert "Generate" not in words._jdf.queryExecution().executedPlan().toString()
    assert not lm.word_counts(spark.createDataFrame([], "doc_id long, text string")).collect()


def test_lm_softmax_of_logits_of_any_size():
    x = np.array([[0, 1, 2], [-500, -400, -401], [300, 0, 1], [-80, -90, -100], [-1e30, 0, 59]], np.float32)
    for rows in (x, x[:1], x[1:2], x[:0]):
        y = rows.astype(float) - rows.max(axis=1, initial=-np.inf)[:, None]
        want = np.exp(y) / np.exp(y).sum(axis=1)[:, None]
        assert np.allclose(lm.softmax(rows.copy()), want, atol=1e-6)
        which = np.argmax(rows, axis=1) if len(rows) else np.zeros(0, int)
        assert np.allclose(lm.log10_softmax(rows.copy(), which), np.log10(want[np.arange(len(rows)), which]), atol=1e-6)


def test_lm_learns_from_every_token(spark):
    words = [f"w{i}".encode() for i in range(50)]
    train = spark.createDataFrame([(i, " ".join(f"w{j}" for j in range(10 * i, 10 * i + 10))) for i in range(5)], "doc_id long, text string")
    model = lm.trained(train, lm.counted(lm.word_counts(train)))
    flat = [w for i in range(0, 50, 10) for w in (*words[i : i + 10], lm.END)]
    _, _, _, h = lm.Reader(model).known([lm.END, *flat])
    rows, _ = lm.features(np.arange(0, 56, 11), h[1:], np.arange(55))
    assert (model.weights[rows] != 0).any(axis=2).all()


def test_mix_keeps_to_windows_and_weights(docs):
    got = mixing.mix(docs, {"src0": 0.5, "src1": 0.3, "src2": 0.2, "gone": 0}, block_rows=2, bucket_rows=20).toPandas()
    own = got[got["slot"].notna()]
    assert set(own["source"]) == {"src0", "src1", "src2"} and own["position"].is_unique
    assert ((own["slot"] >= own["release"]) & (own["slot"] < own["deadline"])).all()
    kept = own[own["kept"]].drop_duplicates(["source", "block"]).sort_values("slot")
    assert list(kept["slot"]) == list(range(len(kept)))
    for s, w in (("src0", 0.5), ("src1", 0.3), ("src2", 0.2)):
        lag = (kept["source"] == s).cumsum() - w * np.arange(1, len(kept) + 1)
        assert lag.abs().max() < 1
    for s, g in own.groupby("source"):
        assert sorted(g["block"].value_counts().iloc[:-1].unique()) in ([2], [])


def test_schedule_meets_all_deadlines():
    rnd = random.Random(2)
    for _ in range(60):
        shares = mixing.units({str(i): rnd.random() ** 3 for i in range(rnd.randint(1, 30))}, rnd.choice([30, 97, 200]))
        period, done = sum(shares.values()), Counter()
        for t, s in enumerate(mixing.schedule(shares), 1):
            done[s] += 1
            assert all(abs(done[k] - t * w / period) < 1 for k, w in shares.items())


@pytest.mark.parametrize("few, name", [(1, "tiny"), (3, None)])
def test_mix_keeps_every_row_beside_a_tiny_source(spark, few, name):
    sizes = {"a": 700, "b": 300, "c": 150, name: few}
    rows = [(i, s) for i, s in enumerate(s for s, n in sizes.items() for _ in range(n))]
    table = spark.createDataFrame(rows, "doc_id long, source string").repartition(7)
    out = [(r.doc_id, r.source) for r in mixing.mixed(table).collect()]
    assert sorted(out) == rows
    weights = {"a": 0.5, "b": 0.3, "c": 0.1, name or "": 0.1}
    got = mixing.mix(table, weights).toPandas()
    assert ((got["slot"] >= got["release"]) & (got["slot"] < got["deadline"])).all()
    turns = got.drop_duplicates(["source", "block"]).sort_values("slot")
    assert list(turns["slot"]) == list(range(len(turns))) and not got["kept"].all()
    # Once the tiny source is gone, the others keep to their weights among each other.
    after = turns[~turns["kept"]].head(60)
    for s in "abc":
        lag = (after["source"] == s).cumsum() - weights[s] / 0.9 * np.arange(1, 61)
        assert lag.abs().max() < 1


def test_mix_keeps_to_exact_weights():
    weights = {"third": 1 / 3, "odd": 0.1234, "rare": 0.00004}
    weights["rest"] = 1 - sum(weights.values())
    shares = mixing.exact(weights)
    names, total, done = list(shares), sum(shares.values()), Counter()
    for i, k, release, deadline, slot, phase in mixing.phases([shares[s] for s in names], [10**9] * 4):
        assert k == done[i] and release <= slot < deadline and phase == 0
        done[i] += 1
        if slot % 1000 == 0 or i == names.index("rare"):
            assert all(abs(done[j] * total - (slot + 1) * shares[s]) < total for j, s in enumerate(names))
        if slot == 200_000:
            break
    assert all(abs(done[j] - 200_001 * w / sum(weights.values())) < 1 for j, w in enumerate(weights.values()))


def test_mix_weighs_exactly(spark):
    table = spark.range(12_000).selectExpr("id AS doc_id", "IF(id % 3 = 0, 'a', 'b') AS source")
    got = mixing.mix(table, {"a": 0.1234, "b": 0.8766}, block_rows=1).where("kept").toPandas().sort_values("slot")
    assert len(got) > 9000
    assert ((got["source"] == "a").cumsum() - 0.1234 * np.arange(1, len(got) + 1)).abs().max() < 1
    low = mixing.mix(table, {"a": 1e-300, "b": 1.0}).agg(F.count("slot"), F.max("slot")).first()
    assert tuple(low) == (12_000, 2999)


def brute_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i : i + 3]), 42) for i in range(max(1, len(words) - 2))]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def classes(prints, distance=2):
    ids = sorted(prints)
    own = {i: i for i in ids}

    def find(i):
        while own[i] != i:
            i = own[i]
        return i
    for i in ids:
        for j in ids:
            if i < j and (prints[i] ^ prints[j]).bit_count() <= distance:
                a, b = sorted((find(i), find(j)))
                own[b] = a
    return {i: find(i) for i in ids}


def test_simhash_classes_equal_brute_force(docs):
    some = docs.where("doc_id < 300")
    prints = {r.doc_id: brute_fingerprint(r.text) for r in some.collect()}
    want = classes(prints)
    got = simhash.op9(some).collect()
    assert {r.doc_id: r.fingerprint for r in got} == {i: f"{p:016x}" for i, p in prints.items()}
    assert {r.doc_id: r.component_id for r in got} == want


@pytest.mark.parametrize("bucket", [512, 1])
def test_links_lose_nothing(spark, bucket):
    rnd = random.Random(bucket)
    prints = {}
    for c in range(12):
        center = rnd.getrandbits(64)
        for k in range(20):
            prints[c * 20 + k] = center ^ sum(1 << b for b in set(rnd.choices(range(64), k=rnd.randint(0, 3))))
    values = sorted(set(prints.values()))
    signed = {simhash._signed(v): v for v in values}
    want = classes({i: v for i, v in enumerate(values)})
    edges = simhash.links(spark.createDataFrame([(s,) for s in signed], "fp long"), bucket=bucket)
    assert all((signed[r.a] ^ signed[r.b]).bit_count() <= 2 for r in edges.collect())
    number = {v: i for i, v in enumerate(values)}
    got = {number[signed[r.id]]: r.component for r in components(edges).collect()}
    parts = lambda m: {frozenset(k for k in m if m[k] == c) for c in m.values()}
    assert parts(got) == {p for p in parts(want) if len(p) > 1}


def test_components_of_long_paths(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(500, 400), (400, 500), (7, 7)], "a long, b long")
    got = {r.id: r.component for r in components(edges).collect()}
    assert got == {i: 0 for i in range(201)} | {400: 400, 500: 400}


@pytest.mark.parametrize("piece", [100_000, 15])
def test_shards_are_even_and_gapless(docs, odd, piece):
    own = docs.unionByName(odd.select(docs.columns)).unionByName(docs.where("doc_id = 5").crossJoin(docs.sparkSession.range(300)).select((F.col("id") + 5000).alias("doc_id"), *docs.columns[1:]))
    got = sharding.shard(own, piece_rows=piece).toPandas()
    largest, size = got["size"].max(), got.groupby("shard")["size"].sum()
    assert len(got) == own.count() and size.max() - size.min() <= 2 * largest + 0.01 * size.mean()
    for _, g in got.groupby("shard"):
        assert sorted(g["slot"]) == list(range(len(g)))
    assert all(r.size == len((r.text or "").encode()) + 1 and r.text_crc32 == zlib.crc32((r.text or "").encode()) for r in got.itertuples())
    many = got.groupby(got["text"].fillna(""))["shard"].nunique()
    assert (many > 1).sum() <= 7


def shingle_set(text):
    w = (text or "").lower().split()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def test_near_texts_equal_brute_force(docs):
    sets = {r.doc_id: shingle_set(r.text) for r in docs.collect()}
    ids, parent = sorted(sets), {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for n, i in enumerate(ids):
        for j in ids[:n]:
            a, b = sets[i], sets[j]
            if min(len(a), len(b)) >= 0.8 * max(len(a), len(b)) and jaccard(a, b) >= 0.8:
                parent[max(root(i), root(j))] = min(root(i), root(j))
    got = {r.doc_id: r.component_id for r in simhash.similar_texts(docs).collect()}
    assert sorted(got) == ids
    assert all(got[i] == got[got[i]] and root(got[i]) == root(i) for i in ids)  # no link below the similarity
    assert sum(got[i] != root(i) for i in ids) <= 1  # pairs just at it may be missed


def test_edited_copies_go_and_others_stay(spark):
    rnd = random.Random(5)
    words = [f"w{i}" for i in range(4000)]
    rows, near, far = [], [], []
    for k in range(120):
        text = [rnd.choice(words) for _ in range(300)]
        rows.append((10 * k, " ".join(text)))
        for m in (1, 3, 5, 12):  # words replaced, far apart: five shingles each
            edited = list(text)
            for p in rnd.sample(range(5, 295, 7), m):
                edited[p] = "new"
            rows.append((10 * k + m if m < 10 else 10 * k + 9, " ".join(edited)))
            similar = jaccard(shingle_set(" ".join(text)), shingle_set(" ".join(edited)))
            (near if similar >= 0.8 else far).append(rows[-1][0])
    assert len(near) == 360 and len(far) == 120
    table = spark.createDataFrame(rows, "doc_id long, text string")
    kept = {r.doc_id for r in simhash.dedup(table.repartition(5)).collect()}
    assert kept >= {10 * k for k in range(120)} and len(kept & set(near)) <= 2
    assert len(kept & set(far)) == 120


def test_near_texts_of_a_crowd_and_of_repeated_ids(spark):
    rnd = random.Random(6)
    text = [f"w{rnd.randrange(4000)}" for _ in range(200)]
    crowd = [(i, " ".join(text[:p] + [f"x{i}"] + text[p + 1 :])) for i, p in ((i, rnd.randrange(200)) for i in range(2000))]
    other = " ".join(f"v{i}" for i in range(50))
    rows = crowd + [(5000, other), (5001, other.upper()), (5001, "quite another text, which stays"), (None, other), (6000, None), (6001, " \n"), (6002, "")]
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(9)
    kept = sorted((r.doc_id for r in simhash.dedup(table).collect()), key=str)
    # An id of which one row is kept keeps all its rows; a row without an id stays.
    assert kept == [0, 5000, 5001, 5001, 6000, None]


def test_near_texts_of_a_crowd_meet_all_of_it(spark):
    # One block, so that all meet in one bucket: pairs of near copies, which stand far apart in it.
    rnd = random.Random(7)
    rows, common = [], [f"c{i}" for i in range(60)]
    for k in range(30):
        text = common + [f"w{k}x{i}" for i in range(40)]
        rows += [(k, " ".join(text)), (1000 - k, " ".join([*text[:-1], "end"]))]
    rnd.shuffle(rows)
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    kept = simhash.bands
    try:
        simhash.bands = lambda n, *_: [[]]
        got = {r.doc_id: r.component_id for r in simhash.similar_texts(table).collect()}
    finally:
        simhash.bands = kept
    assert got == {d: min(d, 1000 - d) for d, _ in rows}


def test_pipeline_drops_copies_and_keeps_the_rest(spark, docs):
    kept = corpus_pipeline.near_duplicates(spark, corpus_pipeline.language(spark, docs, ""), "")
    assert kept.select("text").distinct().count() == kept.count() > 0.85 * docs.count()
    out = corpus_pipeline.run(spark, "/root/testdata/sf0.001").collect()
    assert out and all(r.round_trip for r in out) and len({r.doc_id for r in out}) == len(out)


def test_a_written_step_leaves_no_shuffle_files(spark):
    def files():
        return {str(f) for f in spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString(" ").split(" ") if "shuffle_" in f}

    before = files()
    step = written(spark.range(5000).repartition(7, "id").groupBy("id").count())
    until = time.monotonic() + 20
    while files() - before and time.monotonic() < until:
        time.sleep(0.1)
    assert not files() - before
    assert step.count() == 5000 and spark.conf.get(CLEANUP, None) is None


def test_a_large_bucket_of_texts_that_share_a_passage_is_not_compared_in_pairs(spark, monkeypatch):
    # All in one bucket: half of each text is common to all, and 20 pairs of near copies are among them.
    common = [f"c{i}" for i in range(60)]
    texts = [[*common, *(f"w{k}x{i}" for i in range(40))] for k in range(200)]
    rows = [(k, " ".join(t)) for k, t in enumerate(texts)] + [(1000 + k, " ".join([*texts[k][:-1], "end"])) for k in range(20)]
    random.Random(8).shuffle(rows)
    met, near = [], simhash._near

    def counted(pairs, *args):
        met.append(pairs.count())
        return near(pairs, *args)

    monkeypatch.setattr(simhash, "_near", counted)
    monkeypatch.setattr(simhash, "bands", lambda n, *_: [[]])
    got = {r.doc_id: r.component_id for r in simhash.similar_texts(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)).collect()}
    assert got == {d: d % 1000 for d, _ in rows}
    assert sum(met) < 10 * len(rows)


def test_a_large_group_of_near_copies_is_linked_by_a_few_comparisons_each(spark, monkeypatch):
    rnd = random.Random(10)
    text = [f"w{i}" for i in range(200)]
    rows = [(i, " ".join(text[:p] + [f"x{i}"] + text[p + 1 :])) for i, p in ((i, rnd.randrange(200)) for i in range(600))]
    met, near = [], simhash._near

    def counted(pairs, *args):
        met.append(pairs.count())
        return near(pairs, *args)

    monkeypatch.setattr(simhash, "_near", counted)
    got = {r.doc_id: r.component_id for r in simhash.similar_texts(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)).collect()}
    assert set(got.values()) == {0} and len(got) == 600
    assert sum(met) < 4 * len(rows)


def test_rare_meetings_hold_all_similar_pairs(spark):
    rnd = random.Random(9)
    sets = []
    for _ in range(40):
        base = rnd.sample(range(400), rnd.randrange(1, 60))
        for _ in range(3):
            sets.append(sorted({x if rnd.random() < 0.93 else rnd.randrange(400) for x in base}))
    held = spark.createDataFrame([(i, i, s) for i, s in enumerate(sets)], "node long, component long, shingles array<long>")
    got = {(r.a, r.b) for r in simhash.rare_meetings(held).collect()}
    alike = {(i, j) for j in range(len(sets)) for i in range(j) if 5 * len(set(sets[i]) & set(sets[j])) >= 4 * len(set(sets[i]) | set(sets[j]))}
    assert len(alike) > 30 and alike <= got


def test_row_sums_hold_every_example_and_its_square():
    rnd = np.random.default_rng(5)
    rows = np.where(rnd.random((600, 4)) < 0.3, rnd.integers(0, 3, (600, 4)), rnd.integers(0, lm.ROWS, (600, 4)))
    values = rnd.random((600, 7)).astype(np.float32)
    own, sums, squares = lm.row_sums(rows, values)
    want, square = np.zeros((lm.ROWS, 7)), np.zeros(lm.ROWS)
    np.add.at(want, rows.ravel(), np.repeat(values, 4, axis=0))
    np.add.at(square, rows.ravel(), np.repeat((values.astype(float) ** 2).sum(axis=1), 4))
    assert sorted(own) == sorted(set(rows.ravel()))
    assert np.allclose(sums, want[own], rtol=1e-5) and np.allclose(squares, square[own], rtol=1e-5)
