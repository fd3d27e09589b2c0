"""Findings of round 3: single-pass verdicts, and fits that share their tables."""

import numpy as np
from pyspark.sql import functions as F

from cartwheel.operators import contract as C

KEYS = ["user_id", "session_date"]


def test_findings_beside_the_row_are_those_of_the_long_form(spark):
    bodies = ["no json", None, "[1]", '{"Month":"May","Administrative":-1,"BounceRates":2,"Weekend":"x","odd":1}',
              '{"PageValues":1e999,"page_values":-1,"Browser":0,"VisitorType":null}']
    df = spark.createDataFrame([(str(i), b) for i, b in enumerate(bodies)], "request_id string, body string")
    long = sorted(tuple(r) for r in C.request_violations(df).select("request_id", "field", "rule").collect())
    wide = C.with_request_findings(df).select("request_id", F.inline("found"))
    assert sorted(tuple(r) for r in wide.collect()) == long and len(long) > 20


def test_infinity_verdicts_judge_rows_in_place(spark):
    kinds = {"Month": "'May'", "VisitorType": "'Other'", "Weekend": "true", "Revenue": "false"}
    cols = ", ".join(f"{kinds.get(c, 'CAST(1 AS DOUBLE)' if c in C.FLOAT_FIELDS or c in C.RATE_FIELDS else '1L')} AS {c}" for c in C.EXPECTED_COLUMNS)
    rows = spark.sql(f"SELECT id AS user_id, DATE'2024-01-05' AS session_date, {cols} FROM range(8)")
    out = C.infinity_verdicts(C.infinite_sessions(rows), KEYS)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan
    got = {(r.user_id, r.rule_set, r.column): r.verdict for r in out.collect()}
    slot = lambda u: (u * 31 + 5) % 4
    for u in range(8):
        assert got[u, "dataset", "ProductRelated_Duration"] == ("non_negative" if slot(u) == 1 else "passes")
        assert got[u, "request", "ProductRelated_Duration"] == {0: "not_finite", 1: "range"}.get(slot(u), "passes")
        assert got[u, "request", "PageValues"] == ("not_finite" if slot(u) == 2 else "passes")
    assert len(got) == 32


def test_forest_grown_in_parts_scores_by_all_its_trees(spark):
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.functions import vector_to_array

    from cartwheel.operators import train as T

    raw = spark.range(400).select("id", (F.col("id") % 7).cast("double").alias("x"), (F.col("id") % 5).cast("double").alias("y"),
                                  (F.col("id") % 7 > 3).cast("double").alias(T.LABEL_IDX), F.lit(1.0).alias(T.WEIGHT))
    rows = VectorAssembler(inputCols=["x", "y"], outputCol="features").transform(raw)
    learners = T.forest_parts(T.forest(trees=7, depth=3), 3)
    assert [m.getNumTrees() for m in learners] == [3, 3, 1] and len({m.getSeed() for m in learners}) == 3
    whole, grown = T.fit_all([(T.forest(trees=2, depth=3), rows), (T.forest(trees=7, depth=3), rows)], part_trees=3)
    assert whole.getNumTrees == 2 and sum(m.getNumTrees for m in grown.parts) == 7
    each = [{r.id: r.p for r in m.transform(rows).select("id", vector_to_array("probability")[1].alias("p")).collect()} for m in grown.parts]
    got = grown.transform(rows).select("id", vector_to_array("probability").alias("p"), "prediction").collect()
    assert len(got) == 400
    for r in got:
        assert abs(r.p[1] - (3 * each[0][r.id] + 3 * each[1][r.id] + each[2][r.id]) / 7) < 1e-12 and abs(sum(r.p) - 1) < 1e-12
        assert r.prediction == float(r.p[1] > r.p[0])


def test_folds_are_derived_once_for_a_search(spark):
    from cartwheel.operators import search as S
    from cartwheel.operators import train as T

    seen = spark.sparkContext.accumulator(0)

    def counted(i):
        seen.add(1)
        return i

    once = F.udf(counted, "long")
    df = spark.range(200).select((once("id") % 4).cast("double").alias("x"), (F.col("id") % 4 > 1).cast("double").alias(T.LABEL_IDX),
                                 F.lit(1.0).alias(T.WEIGHT), (F.col("id") % 5).cast("int").alias("fold"))
    c = T.Candidate("l", "linear", "l", "s", T.logistic(5, 0.0), ("x",), ())
    assert [r[4] for r in S.cross_validate(c, [{"maxIter": 3}], df)] == ["FINISHED"] * 5
    assert seen.value == 200


def test_block_of_ids_is_the_same_counted_or_sorted(monkeypatch):
    import numpy as np

    from cartwheel.llm import tokenfile

    rng = np.random.default_rng(3)
    for top in (3, 300, 70_000):
        ids = (rng.zipf(1.3, 20_000) % top).astype(np.uint32)
        sizes = np.array([15_000, 0, 5_000])
        with monkeypatch.context() as m:
            m.setattr(tokenfile, "DENSE", 0)
            by_sorting = tokenfile.pack(ids, sizes)
        with monkeypatch.context() as m:
            m.setattr(np, "unique", None)  # the ids of a block are not sorted
            assert tokenfile.pack(ids, sizes) == by_sorting
        got, parts = tokenfile.unpack(by_sorting)
        assert (got == ids).all() and parts.tolist() == sizes.tolist()
    assert tokenfile.unpack(tokenfile.pack(np.zeros(0, np.uint32), np.zeros(1, np.int64)))[0].size == 0


def test_words_once_encoded_are_not_cut_again(monkeypatch):
    from tokenizers import Tokenizer

    from cartwheel.llm import tokens

    library = Tokenizer.from_file(tokens.vocabulary_path())
    enc = tokens.WordEncoder(tokens.vocabulary_path())
    texts = ["one two\tthree two", " \n ", "two  éé One's 12", None, "x"]
    want = [library.encode(t or "", add_special_tokens=False).ids for t in texts]
    cut, learn = [], enc._learn
    monkeypatch.setattr(enc, "_learn", lambda pieces, marked: (cut.extend(pieces), learn(pieces, marked)))
    assert [np.frombuffer(x, "<u4").tolist() for x in enc.encode(texts)] == want and cut
    cut.clear()
    assert [np.frombuffer(x, "<u4").tolist() for x in enc.encode(texts[::-1])] == want[::-1] and not cut
    monkeypatch.setattr(tokens, "WORDS_STORED", 2)  # forgets at each call
    for t, ids in zip(texts * 2, want * 2, strict=True):
        assert np.frombuffer(enc.encode([t])[0], "<u4").tolist() == ids
    assert len(enc.words) <= 5


def test_workers_forget_what_another_operator_learnt():
    from cartwheel.llm import common

    kept = common.worker_cache()
    common.serve("a")
    kept["x"] = 1
    common.serve("a")
    assert kept == {"x": 1}
    common.serve("b")
    assert kept == {}


def test_small_tables_of_near_duplicates_are_written_in_few_files(spark, monkeypatch):
    from cartwheel.llm import common, near

    files = {}

    def written(df, name, *args):
        out = common.materialize(df, name, *args)
        files[name] = len(out.inputFiles())
        return out

    rng = np.random.default_rng(3)
    rows = [(i, " ".join(map(str, rng.integers(0, 10**6, 40) if i % 2 == 0 else [*range(i // 10, i // 10 + 60), i]))) for i in range(400)]
    held = {"spark.sql.shuffle.partitions": "97", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in held}
    try:
        for k, v in held.items():
            spark.conf.set(k, v)
        want = sorted(map(tuple, near.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).select("doc_id", "class_id", "class_size").collect()))
        monkeypatch.setattr(near, "materialize", written)
        monkeypatch.setattr(common, "FILE_BYTES", 1 << 40)
        monkeypatch.setattr(type(spark.sparkContext), "defaultParallelism", 2)
        got = sorted(map(tuple, near.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).select("doc_id", "class_id", "class_size").collect()))
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert got == want and len({c for _, c, _ in got}) < 400
    assert max(n for name, n in files.items() if name not in ("near-codes", "near-vectors", "near-blocks", "near-all-links")) <= 4


def test_trie_looks_tokens_up_at_few_lengths():
    import random

    from tokenizers import Tokenizer

    from cartwheel.llm import bpe_trie, tokens

    class Counted(dict):
        asked = 0

        def get(self, key, default=None):
            self.asked += 1
            return super().get(key, default)

    draw = random.Random(3)
    parts = ["th", "er", "tion", "en", "ou", "sch", "ée", "ña", "ight", "q"]
    words = ["".join(draw.choices(parts, k=draw.randint(1, 7))) + draw.choice(["", ",", ".", "###"]) for _ in range(3000)]
    texts = [*(" ".join(words[i:i + 100]) for i in range(0, 3000, 100)), None, "", " \n ", "日本 " + words[0]]
    library, coder = Tokenizer.from_file(tokens.vocabulary_path()), bpe_trie.TrieBpe(tokens.vocabulary_path())
    want = [library.encode(t or "", add_special_tokens=False).ids for t in texts]
    shown = [library.decode(ids, skip_special_tokens=False) for ids in want]
    coder.id_of = Counted(coder.id_of)
    for asks in (True, False):  # what is learnt is not looked up again
        coder.id_of.asked = 0
        got = list(coder.encode(texts[:30]))
        assert (0 < coder.id_of.asked < 4 * sum(len(w.encode()) for w in set(words))) if asks else coder.id_of.asked == 0
        assert [np.frombuffer(ids, "<u4").tolist() for ids, _ in got] == want[:30] and [t.decode() for _, t in got] == shown[:30]
    got = list(coder.encode(texts))
    assert [np.frombuffer(ids, "<u4").tolist() for ids, _ in got] == want and [t.decode() for _, t in got] == shown


def test_encoder_keeps_words_and_pieces_in_arrays(monkeypatch):
    from tokenizers import Tokenizer

    from cartwheel.llm import tokens

    library = Tokenizer.from_file(tokens.vocabulary_path())
    texts = ["one two, three### two", "éé-One's 12 ÿ", "日本 two, éé", None, "</w> a</w>b Ā", "x\0y z"]
    want = [library.encode(t or "", add_special_tokens=False).ids for t in texts]
    loaded = []

    class Counted:
        @staticmethod
        def from_file(path):
            loaded.append(path)
            return Tokenizer.from_file(path)

    monkeypatch.setattr(tokens, "Tokenizer", Counted)
    enc = tokens.WordEncoder(tokens.vocabulary_path())
    assert len(loaded) == 1  # a worker holds the file's model once
    asked, merge = [], enc.merge
    monkeypatch.setattr(enc, "merge", lambda pieces, marked: (asked.extend(pieces), merge(pieces, marked))[1])
    assert [np.frombuffer(x, "<u4").tolist() for x in enc.encode(texts[:2])] == want[:2]
    assert not enc.known and not enc.older and len(enc.stems) == len(set(asked)) + 1 == len(asked) + 1
    asked.clear()
    enc.encode(["two one### three,", "12"])  # other words of the same pieces
    assert not asked
    assert [np.frombuffer(x, "<u4").tolist() for x in enc.encode(texts)] == want
    enc.closing[:] = False  # as for a file whose tokens do not tell where a word ends
    enc.words, enc.stems, enc.known, enc.older = tokens._Stored(), tokens._Stored("\n", [tokens._LINE_END]), {}, {}
    assert [np.frombuffer(x, "<u4").tolist() for x in enc.encode(texts)] == want
    monkeypatch.setattr(tokens, "WORDS_STORED", 2)
    monkeypatch.setattr(tokens, "PIECES_STORED", 3)
    for t, ids in zip(texts * 2, want * 2, strict=True):
        assert np.frombuffer(enc.encode([t])[0], "<u4").tolist() == ids
    assert len(enc.stems) <= 12


def test_block_is_packed_with_few_bytes_an_id():
    import struct
    import tracemalloc

    from cartwheel.llm import tokenfile

    rng = np.random.default_rng(3)
    for top, n in ((200, 1), (200, 6), (300, 70_001), (70_000, 1 << 18)):
        ids = np.concatenate([np.arange(top if n > 6 else 0), rng.zipf(1.3, n) % top]).astype(np.uint32)
        sizes = np.array([len(ids) - 1, 0, 1])
        tracemalloc.start()
        payload = tokenfile.pack(ids, sizes)
        packed = tracemalloc.get_traced_memory()[1]
        tracemalloc.reset_peak()
        back, parts = tokenfile.unpack(payload)
        unpacked = tracemalloc.get_traced_memory()[1] - len(payload)
        tracemalloc.stop()
        assert (back == ids).all() and parts.tolist() == sizes.tolist()
        values, counts = np.unique(ids, return_counts=True)
        table = values[np.argsort(-counts, kind="stable")].tolist()
        rank = {v: i for i, v in enumerate(table)}
        codes, data = [0] * (-(-len(ids) // 4)), bytearray()
        for i, v in enumerate(ids.tolist()):
            width = max(1, -(-rank[v].bit_length() // 8))
            codes[i // 4] |= (width - 1) << (2 * (i % 4))
            data += rank[v].to_bytes(width, "little")
        head = [3, len(ids), len(table), *table, *sizes.tolist()]
        assert payload == b"FRV1" + struct.pack(f"<{len(head)}I", *head) + bytes(codes) + bytes(data)
        assert n < 1 << 18 or (packed < 30 * len(ids) and unpacked < 30 * len(ids))


def test_rotations_are_sorted_in_few_rounds_and_expansion_goes_on_from_there(monkeypatch):
    from cartwheel.llm import suffix

    rng = np.random.default_rng(3)
    own = rng.integers(1, 4, 700).astype(np.uint8)
    data = np.concatenate([own, [0], own[100:650], [0], rng.integers(1, 4, 300), [0], own[:500], [0]]).astype(np.uint8)
    n, sort, sorts = len(data), np.argsort, []
    raw = (data.tobytes() * 2)
    for depth in (2, 9, 25, 400):
        with monkeypatch.context() as m:
            m.setattr(np, "argsort", lambda *a, **k: (sorts.append(len(a[0])), sort(*a, **k))[1])
            order, ends, known = suffix.rotation_order(data, depth)
        strings = [raw[i:i + depth] for i in order]
        assert strings == sorted(strings) and sorted(order.tolist()) == list(range(n)) and known < depth
        assert ends.tolist() == [i for i in range(1, n + 1) if i == n or strings[i][:known] != strings[i - 1][:known]]
        order, same = suffix.shared_prefixes(data, depth)
        strings = [raw[i:i + depth] for i in order]
        assert same.tolist() == [i > 0 and strings[i] == strings[i - 1] for i in range(n)] and same.any()
    assert len(sorts) == 2 + 2 + 3 + 5  # the sorts double no longer: 8, 24, 72, 216, 400
    big = np.tile(own, 3000)  # three of its ranks have more than 63 bits
    order, same = suffix.shared_prefixes(big, 400)
    assert 3 * len(big).bit_length() > 63 and same.sum() == len(big) - 700
    step = np.flatnonzero(~same)
    windows = [np.tile(own, 2)[i:i + 400].tobytes() for i in order[step] % 700]
    assert windows == sorted(windows) and len(set(windows)) == 700
