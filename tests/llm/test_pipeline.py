import hashlib
import re
import subprocess
import sys
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from textmart.llm import queries

REPO = Path(corpus_pipeline.__file__).parent
BAD = ["loser", "scum", "moron"]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rng = np.random.default_rng(8)
    words = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(400)]
    docs, labels = [], []
    for i in range(300):
        text = list(rng.choice(words, rng.integers(8, 120)))
        toxic = int(i % 6 == 0)
        for _ in range(4 * toxic):
            text.insert(rng.integers(len(text)), str(rng.choice(BAD)))
        docs.append((i, " ".join(text), ["en", "de", None][i % 3], f"src{i % 4 if i % 2 else 0}"))
        if i < 240:
            labels.append((i, 1, toxic))
    docs += [(1000, docs[1][1], "en", "src0"), (1001, docs[7][1] + " plus", "en", "src1"), (1002, "mail ann@x.example.com and 10.1.2.3 please, " + " ".join(rng.choice(words, 60)), "en", "src2")]
    docs += [(1003, None, None, None), (1004, "", "en", "src0"), (2, docs[2][1], "de", "src0"), (None, "no id " + " ".join(rng.choice(words, 30)), "fr", "src3")]
    path = tmp_path_factory.mktemp("tables")
    frame = spark.createDataFrame(docs, "doc_id long, text string, lang string, source string").withColumn("n_chars", F.length("text").cast("long"))
    frame.repartition(3).write.parquet(str(path / "documents.parquet"))
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(path / "labels.parquet"))
    return str(path), docs


def test_each_stage_on_its_input(spark, folder):
    path, docs = folder
    current, after = spark.read.parquet(f"{path}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, current, path)
        if name != "encoding":
            assert out.columns == corpus_pipeline.COLUMNS
        current = corpus_pipeline.written(out, name)
        after[name] = [r.asDict() for r in current.collect()]
    toxic = {i for i, t, *_ in docs if t and set(BAD) & set(t.split())}
    kept = {r["doc_id"] for r in after["toxicity"]}
    assert len(kept & toxic) <= 0.1 * len(toxic) and len({d[0] for d in docs} - toxic - kept) <= 0.02 * len(docs)
    ids = [r["doc_id"] for r in after["near_duplicates"]]
    assert len(ids) == len(set(ids)) and not {1000, 1001} & set(ids) and {1, 2, 7, 1002, 1003, 1004, None} <= set(ids) | (toxic & {1, 2, 7})
    assert set(ids) == kept - {1000, 1001}
    changed = {r["doc_id"]: r for r in after["personal_data"]}
    before = {r["doc_id"]: r for r in after["near_duplicates"]}
    assert set(changed) == set(before)
    assert {i for i in changed if changed[i]["text"] != before[i]["text"]} == {1002}
    assert "ann@x" not in changed[1002]["text"] and "10.1.2.3" not in changed[1002]["text"] and changed[1002]["n_chars"] == len(changed[1002]["text"])
    mixed = [r["doc_id"] for r in after["mixture"]]
    assert set(mixed) == {i for i, r in changed.items() if (r["text"] or "").split()} and len(mixed) > len(set(mixed))
    library = Tokenizer.from_file(public_tokenizers.path(queries.WORD_BPE))
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in after["encoding"]) == sorted((i is None, i or 0) for i in mixed)
    for r in after["encoding"]:
        coded = library.encode(changed[r["doc_id"]]["text"], add_special_tokens=False).ids
        assert r["n_tokens"] == len(coded) and r["ids_sha256"] == hashlib.sha256(np.array(coded, "<u4").tobytes()).hexdigest()
    assert sorted(map(str, after["encoding"])) == sorted(str(r.asDict()) for r in corpus_pipeline.run(spark, path).collect())


def test_stages_on_empty_tables(spark, folder):
    path, _ = folder
    current = spark.read.parquet(f"{path}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        current = stage(spark, current, path)
        assert current.collect() == []


def test_registered_queries():
    names = [re.match(r"op(\d+)_", n)[1] for n in queries.QUERIES]
    assert sorted(map(int, names)) == list(range(1, 14))


def test_the_rest_does_without_this_part(tmp_path):
    """The other packages import when this one and the pipeline are away."""
    for part in ("textmart", "catalogue", "__spark_entry__.py"):
        (tmp_path / part).symlink_to(REPO / part)
    code = (
        "import sys\n"
        "class Away:\n"
        "    def find_spec(self, name, path=None, target=None):\n"
        "        if name.startswith(('textmart.llm', 'corpus_pipeline')): raise ModuleNotFoundError(name, name=name)\n"
        "sys.meta_path.insert(0, Away())\n"
        f"sys.path.insert(0, {str(REPO)!r})\n"
        "import __spark_entry__ as e\n"
        "assert not [n for n in e.queries() if n.startswith('op') or n == 'pipeline'] and len(e.queries()) > 70 and set(e.oracle_sql()) <= set(e.queries())\n"
    )
    subprocess.run([sys.executable, "-c", code], check=True, cwd=tmp_path)
