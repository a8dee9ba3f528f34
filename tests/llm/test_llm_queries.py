"""The queries on the smallest given tables, and the pipeline, against plain Python."""

import os
import sys
import zlib
from pathlib import Path

import numpy as np
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent.parent))
sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import functions as F
from test_alignment import expected as brute_alignment
from test_collocations import brute as brute_collocations
from test_decontamination import brute as brute_passages
from test_licenses import brute as brute_licenses
from test_near_duplicates import brute_groups, plain_print
from test_quality_rules import brute as brute_measures
from test_vector_search import brute as brute_top_k

from __spark_entry__ import queries
from corpus_pipeline import STAGES
from tillmart.llm.catalogue import BYTE_BPE, QUERIES
from tillmart.llm.language_id import FEWEST_BACKWARDS, learn_bounded, phrases
from tillmart.llm.token_ids import Encoder

SF_DIR = os.environ.get("TILLMART_TESTDATA", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not Path(SF_DIR).is_dir(), reason="no test tables here")


@pytest.fixture(scope="module")
def docs(spark):
    return [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()]


def test_every_query_is_registered():
    assert {f"op{n}" for n in range(1, 14)} == {name.split("_")[0] for name in QUERIES}
    assert set(QUERIES) | {"pipeline"} <= set(queries())


def test_decontamination(spark, docs):
    items = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").select("item_id", "text").collect()]
    got = sorted((tuple(r)[:6] for r in QUERIES["op2_decontamination"](spark, SF_DIR).collect()), key=repr)
    assert got == brute_passages(docs, items)


def digest(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_token_shards_and_packing(spark, docs):
    tokenizer = Encoder(BYTE_BPE).tokenizer
    ids = {d: x.ids for (d, _), x in zip(docs, tokenizer.encode_batch([t or "" for _, t in docs], add_special_tokens=False))}
    want, start = [], 0
    for doc_id in sorted(ids):
        own = ids[doc_id] + [2]
        want.append((doc_id, start, len(own), digest(own)))
        start += len(own)
    assert sorted(tuple(r) for r in QUERIES["op3_token_shards"](spark, SF_DIR).collect()) == want
    packed = QUERIES["op10_packing"](spark, SF_DIR).collect()
    pieces = [(d, s, digest((i + [1])[s:s + 2048])) for d, i in ids.items() for s in range(0, len(i) + 1, 2048)]
    assert sorted((r["doc_id"], r["start"], r["ids_crc32"]) for r in packed) == sorted(pieces)
    tokens = sum(r["length"] for r in packed)
    assert tokens == start and tokens > 0.9 * 2048 * (1 + max(r["sequence_id"] for r in packed))


def test_licenses(spark, docs):
    got = sorted((tuple(r)[:6] for r in QUERIES["op5_licenses"](spark, SF_DIR).collect()), key=repr)
    assert got == sorted(((d, *brute_licenses(t)) for d, t in docs), key=repr)


def test_quality_rules(spark, docs):
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    for r in QUERIES["op6_quality_rules"](spark, SF_DIR).collect():
        m = brute_measures(dict(docs)[r["doc_id"]])
        assert [r[n] for n in names] == [m[n] for n in names]
        assert r["base_failed"] == (m["n_words"] < 50 or 100 * m["n_repeat_words"] > 50 * m["n_words"])


def test_simhash(spark, docs):
    prints = {d: plain_print(t) for d, t in docs}
    group = brute_groups(set(prints.values()))
    least = {}
    for d, p in prints.items():
        least[group[p]] = min(d, least.get(group[p], d))
    want = sorted((d, f"{p:016x}", least[group[p]]) for d, p in prints.items())
    assert sorted(tuple(r) for r in QUERIES["op9_simhash"](spark, SF_DIR).collect()) == want


def test_top_k(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/embeddings.parquet").select("vec_id", "embedding").collect()]
    assert sorted(map(tuple, QUERIES["op11_top_k"](spark, SF_DIR).collect()), key=repr) == brute_top_k(rows)


def test_alignment(spark, docs):
    ids, texts = zip(*docs)
    assert sorted(map(tuple, QUERIES["op12_alignment"](spark, SF_DIR).collect())) == sorted(brute_alignment(ids, texts))


def test_collocations(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("lang", "text").collect()]
    assert sorted(map(tuple, QUERIES["op13_collocations"](spark, SF_DIR).collect())) == brute_collocations(rows, 2000, 100)


def test_classifier_and_languages_on_held_out_documents(spark, docs):
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF_DIR}/labels.parquet").collect()}
    judged = [r for r in QUERIES["op1_quality"](spark, SF_DIR).collect() if r["doc_id"] in labels]
    assert sum(r["kept"] == bool(labels[r["doc_id"]]) for r in judged) > 0.95 * len(judged)
    langs = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "lang").collect()}
    held = [r for r in QUERIES["op8_language"](spark, SF_DIR).collect() if r["held_out"]]
    assert sum(r["lang_pred"] == langs[r["doc_id"]] for r in held) > 0.95 * len(held)


def test_stages_of_the_pipeline(spark, docs, tmp_path):
    """Each stage on what its predecessor kept, its decisions made anew by plain Python where they are rules."""
    columns = spark.read.parquet(f"{SF_DIR}/documents.parquet").columns
    items = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").select("item_id", "text").collect()]
    now = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    for name, stage in STAGES:
        before = {r["doc_id"]: r["text"] for r in now.select("doc_id", "text").collect()}
        learned = now
        stage(spark, now, SF_DIR).write.parquet(str(tmp_path / name))
        now = spark.read.parquet(str(tmp_path / name))
        if name == "packing":
            assert {r["doc_id"] for r in now.select("doc_id").collect()} == set(before)
            continue
        assert now.columns == columns
        after = [r["doc_id"] for r in now.select("doc_id").collect()]
        assert len(after) == len(set(after)) and set(after) <= set(before)
        if name == "quality":
            bad = {r["doc_id"] for r in QUERIES["op1_quality"](spark, SF_DIR).where("not kept").select("doc_id").collect()}
            assert set(before) - set(after) == bad
        elif name == "language":
            lettered = {d: t for d, t in before.items() if t and any(c.isalpha() for c in t)}
            model, bounds = learn_bounded(learned)
            need = {d: phrases([t], model)[0] for d, t in lettered.items()}
            back = {d: phrases([t[::-1]], model)[0] for d, t in lettered.items()}
            best = {d: n.argmin() for d, n in need.items()}
            strange = {d for d, k in best.items() if back[d][k] >= FEWEST_BACKWARDS and need[d][k] > bounds[k] * back[d][k]}
            assert (bounds < 1).all() and set(after) == set(lettered) - strange and len(strange) < 0.02 * len(before)
        elif name == "near_duplicates":
            prints = {d: plain_print(t) for d, t in before.items()}
            group = brute_groups(set(prints.values()))
            least = {}
            for d, p in prints.items():
                least[group[p]] = min(d, least.get(group[p], d))
            assert set(after) == set(least.values())
        elif name == "decontamination":
            found = brute_passages([*before.items()], items)
            assert set(after) == {r[0] for r in found if not r[5]}


def test_stages_take_odd_rows(spark, docs, tmp_path):
    good = [r["doc_id"] for r in QUERIES["op1_quality"](spark, SF_DIR).orderBy(F.desc("score")).limit(1).collect()][0]
    rows = [(None, None, None, None, 0), (-1, "", "en", "s", 1), (-1, "", "en", "s", 1), (-3, "123", "xx", None, None)]
    rows += [(d, dict(docs)[good][:2000], lang, "src1", 1) for d, lang in ((good, "en"), (good, "en"), (None, None))]
    for odd in (rows, []):
        now = spark.createDataFrame(odd, "doc_id long, text string, lang string, source string, n_chars long").withColumn("row", F.lit(1))
        for name, stage in STAGES:
            folder = str(tmp_path / f"{len(odd)}-{name}")
            stage(spark, now, SF_DIR).write.parquet(folder)
            now = spark.read.parquet(folder)
        assert now.count() == (1 if odd else 0)
