"""Each stage of the pipeline on the smallest documents: what it keeps, against plain versions on its own input."""

import collections

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from test_operators import plain_components, plain_fingerprint
from tokenizers import Tokenizer

import corpus_pipeline
from splitweave.llm import secrets
from splitweave.llm.common import written


def test_stages(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    seen = [docs]
    for name, stage in corpus_pipeline.STAGES:
        seen.append(written(stage(spark, seen[-1], sf), name))
    assert all(df.columns == docs.columns for df in seen[:-1])
    texts = [{r["doc_id"]: r["text"] for r in df.collect()} for df in seen[:-1]]
    start, known, single, clean, safe = texts
    assert set(known) == {d for d, t in start.items() if t and any(c.isalpha() for c in t)}
    prints = {d: plain_fingerprint(t) for d, t in known.items()}
    label = plain_components(prints, 4)
    assert set(single) == {d for d in known if label[d] == d}
    copies = collections.Counter(single.values())
    assert max(copies.values()) == 1
    assert clean.keys() == safe.keys() and clean.keys() <= single.keys() and len(clean) > 0.8 * len(single)
    assert not any(secrets.base_spans(t) for t in safe.values())
    assert all(safe[d] == t for d, t in clean.items() if not secrets.all_spans(t))
    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    lengths = collections.Counter()
    for r in seen[-1].collect():
        lengths[r["doc_id"]] += r["length"]
    assert lengths == {d: len(tok.encode(t, add_special_tokens=False).ids) + 1 for d, t in safe.items()}


NAMES = "doc_id text lang source n_chars score lang_pred spans _id secrets row_hash keep_id text_hash class_id component_id doc_id_ column_0 rows words".split()


def odd_documents(spark, sf):
    """Documents with null ids and texts, repeated rows and ids, and columns named as the stages name theirs."""
    given = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars").limit(60).collect()
    rows = [tuple(x) for x in given]
    some = next(x for x in rows if len(x[1]) > 400)
    rows += [some, (some[0], "quite another text that stands alone under an id which is taken, but has words of its own", "en", "web", 1)]
    rows += [(None, some[1], "en", None, None), (10_001, None, None, None, None), (10_002, "", None, None, 0), (10_003, " 123 ", "en", "x", 5), (10_004, "word " * 20_000, None, "x", 100_000)]
    extra = tuple(f"kept {n}" for n in NAMES[5:])
    kind = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{n}` string" for n in NAMES[5:])
    return spark.createDataFrame([(*x, *extra) for x in rows], kind), some


@pytest.mark.parametrize("stage", corpus_pipeline.STAGES[:4], ids=lambda s: s[0])
def test_stages_on_odd_documents(spark, sf, stage):
    docs, some = odd_documents(spark, sf)
    name, function = stage
    out = function(spark, docs, sf)
    assert out.columns == docs.columns == NAMES and [f.dataType for f in out.schema] == [f.dataType for f in docs.schema]
    rows = out.collect()
    assert rows and all(r[n] == f"kept {n}" for r in rows for n in NAMES[5:])
    texts = collections.Counter((r["doc_id"], r["text"]) for r in rows)
    own = (some[0], "quite another text that stands alone under an id which is taken, but has words of its own")
    if name == "secret_scan":
        assert len(rows) == docs.count()
    else:
        assert texts[own] == 1
    if name == "simhash_near_dedup":
        assert texts[some[0], some[1]] <= 1 and (None, some[1]) in texts and max(texts.values()) == 1
    assert function(spark, docs.limit(0), sf).collect() == []


def test_packing_odd_documents(spark, sf):
    docs, _ = odd_documents(spark, sf)
    rows = corpus_pipeline.packed(spark, docs, sf).collect()
    whole = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = sum(len(whole.encode(r["text"] or "", add_special_tokens=False).ids) + 1 for r in docs.collect())
    assert sum(r["length"] for r in rows) == want
    assert corpus_pipeline.packed(spark, docs.limit(0), sf).collect() == []


def test_contaminated_rows_go_and_others_with_their_id_stay(spark, sf):
    item = spark.read.parquet(f"{sf}/benchmark.parquet").where("length(text) > 100").first()["text"]
    docs = spark.createDataFrame(
        [(1, "before " + item + " after", "en", "x", 1), (1, "a clean text of the same id that nobody has tested with anything so far", "en", "x", 1), (None, item, "en", "x", 1), (None, None, None, None, None)],
        "doc_id long, text string, lang string, source string, n_chars long",
    )
    left = corpus_pipeline.uncontaminated(spark, docs, sf).select(F.coalesce("text", F.lit("-"))).collect()
    assert sorted(r[0][:7] for r in left) == ["-", "a clean"]


def test_run_leaves_its_result_only(spark, sf):
    from splitweave.sources.paths import child_names

    root = spark.conf.get("spark.checkpoint.dir")
    before = set(child_names(spark, root))
    rows = corpus_pipeline.run(spark, sf)
    assert rows.count() > 100
    assert [n.rsplit("-", 1)[0] for n in set(child_names(spark, root)) - before] == ["best_fit_packing"]
