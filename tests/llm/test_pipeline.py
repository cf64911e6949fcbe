import importlib
import os
import shutil
import subprocess
import sys
import tempfile

import corpus_pipeline
from colmask.llm import decontaminate, pieces, rules, toxicity
from tests.llm.helpers import no_docs
from tests.llm.test_decontaminate import plain
from tests.llm.test_simhash import plain_fingerprint, plain_roots

SF_DIR = "/root/testdata/sf0.01"


def ids(df):
    return sorted(r["doc_id"] for r in df.select("doc_id").collect())


def test_each_stage_on_its_own_input(spark):
    """Every stage against the operator's verdicts or a plain version, on what the stage before it left."""
    root = tempfile.mkdtemp(prefix="stages-")
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    bench = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").select("item_id", "text").collect()]
    columns = docs.columns
    sizes = [docs.count()]
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, SF_DIR)
        out.write.parquet(f"{root}/{k}")
        out = spark.read.parquet(f"{root}/{k}")
        if k == 0:
            want = ids(rules.quality_verdicts(docs, labels).filter("kept"))
        elif k == 1:
            want = ids(toxicity.toxicity(docs, labels).filter("predicted = 0"))
        elif k == 2:
            rows = sorted(docs.select("doc_id", "text").collect())
            roots = plain_roots([plain_fingerprint(r["text"]) for r in rows])
            want = sorted({rows[r]["doc_id"] for r in roots})
        elif k == 3:
            rows = sorted(docs.select("doc_id", "text").collect())
            want = [r["doc_id"] for r, (_, hit, _) in zip(rows, plain([r["text"] for r in rows], bench)) if not hit]
        else:
            want = ids(docs)
            vocab = pieces.Vocabulary.load()
            texts = {r["doc_id"]: r["text"] for r in docs.collect()}
            for r in out.collect():
                assert r["round_trip"]
                assert b"".join(vocab.pieces[i] for i in r["ids"]).removeprefix(b" ").decode() == texts[r["doc_id"]]
        assert ids(out) == want, name
        if k < 4:
            assert out.columns == columns
            assert sorted(out.collect()) == sorted(docs.join(out.select("doc_id"), "doc_id", "left_semi").collect())
        sizes.append(out.count())
        docs = out
    assert sizes[0] > sizes[1] > sizes[2] > sizes[3] > sizes[4] == sizes[5] > 0.5 * sizes[0]
    assert ids(corpus_pipeline.run(spark, SF_DIR)) == ids(docs)


def test_stages_on_an_empty_table(spark):
    docs = no_docs(spark)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF_DIR).count() == 0


def test_stages_call_the_named_operators():
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality rules", "toxicity", "near-duplicates", "decontamination", "encoding",
    ]
    assert corpus_pipeline.ORACLE_SQL is None
    assert decontaminate.WINDOW == 10


def test_the_rest_works_without_the_text_operators():
    entry = importlib.import_module("__spark_entry__")
    repo = os.path.dirname(os.path.abspath(entry.__file__))
    bare = tempfile.mkdtemp(prefix="bare-") + "/repo"
    skip = shutil.ignore_patterns(".git", "llm", "corpus_pipeline.py", "__pycache__")
    shutil.copytree(repo, bare, ignore=skip)
    code = "import __spark_entry__ as e; print(len(e.queries()), sum(k.startswith('op') for k in e.queries()), len(e.oracle_sql()))"
    said = subprocess.run([sys.executable, "-B", "-c", code], cwd=bare, capture_output=True, text=True, check=True)
    n, ops, sql = map(int, said.stdout.split())
    assert (ops, sql) == (0, n)
    assert n == sum(not k.startswith("op") and k != "pipeline" for k in entry.queries())
