"""The pipeline's stages, one after the other, against plain versions; what is registered and what it needs."""

from __future__ import annotations

import subprocess
import sys
from collections import Counter, defaultdict

import __spark_entry__
import corpus_pipeline
from cartwheel.llm.common import materialize
from tests.llm.conftest import AWKWARD, TINY
from tests.llm.test_near import classes
from tests.llm.test_secrets_warc import redacted
from tests.llm.test_suffix import removed
from tests.llm.test_tokens import LIBRARY, check_packing, crc


def plain(rows, length=400):
    """(doc_id, text) after each of the filtering stages, for distinct non-null ids; the first keeps all rows."""
    labels = classes([t for _, t in rows])
    least = {}
    for (i, _), c in zip(rows, labels, strict=True):
        least[c] = min(i, least.get(c, i))
    rows = [(i, t) for (i, t), c in zip(rows, labels, strict=True) if least[c] == i]
    yield rows
    raws = [t.encode() for _, t in rows]
    rows = [(i, bytes(b for b, g in zip(r, gone, strict=True) if not g).decode("utf-8", "ignore")) for (i, _), r, gone in zip(rows, raws, removed(raws, length), strict=True)]
    yield rows
    yield [(i, redacted(t)) for i, t in rows]


def test_stages(spark, texts):
    docs = spark.read.parquet(f"{TINY}/documents.parquet")
    want = plain(sorted(texts.items()))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        columns = docs.columns
        docs = materialize(stage(spark, docs, TINY), "test")
        assert docs.columns == columns, name
        rows = {r.doc_id: r for r in docs.collect()}
        assert len(rows) == docs.count()
        assert {i: r.text for i, r in rows.items()} == (texts if name == "language_id" else dict(next(want))), name
        assert all(r.n_chars == len(r.text) for r in rows.values())
    out = corpus_pipeline.STAGES[-1][1](spark, docs, TINY).collect()
    by = defaultdict(list)
    for r in out:
        by[r.doc_id].append(r)
    assert by.keys() == rows.keys()
    for i, pieces in by.items():
        ids = [*LIBRARY.encode(rows[i].text, add_special_tokens=False).ids, 0]
        assert [r.ids_crc32 for r in sorted(pieces, key=lambda r: r.piece)] == [crc(ids[k:k + 2048]) for k in range(0, len(ids), 2048)]
    check_packing(out, 2048)
    key = lambda r: (r.doc_id, r.piece, r.length, r.ids_crc32)
    assert sorted(map(key, corpus_pipeline.run(spark, TINY).collect())) == sorted(map(key, out))


def test_stages_on_awkward_rows(spark, awkward, nothing):
    for docs in (awkward, nothing):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            columns = docs.columns
            docs = materialize(stage(spark, docs, TINY), "test")
            assert docs.columns == columns, name
        assert corpus_pipeline.STAGES[-1][1](spark, docs, TINY).columns[:2] == ["doc_id", "piece"]
        assert docs.count() == len({r.doc_id for r in docs.collect()}) <= len(AWKWARD)


def test_registered():
    names = __spark_entry__.queries()
    numbers = Counter(n.split("_")[0] for n in names if n.startswith("op") and n[2].isdigit())
    assert numbers == {f"op{k}": 1 for k in range(1, 14)} and "pipeline" in names
    assert 4 <= len(corpus_pipeline.STAGES) <= 5
    assert corpus_pipeline.ORACLE_SQL is None and "op7_revisits" in __spark_entry__.oracle_sql()


def test_library_imports_nothing_of_this():
    code = "import sys; sys.modules['cartwheel.llm'] = None; import cartwheel.plans.registry as r; print(len(r.queries()))"
    assert int(subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, check=True).stdout) > 50
