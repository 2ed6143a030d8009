import re

import public_tokenizers
from tokenizers import Tokenizer

import __spark_entry__
import corpus_pipeline
from riskloom.llm import decontam, exact, minhash, toxicity
from riskloom.llm.queries import ORACLE, QUERIES


def test_stages_in_turn(spark, sf_dir):
    """Each stage against its operator on what the stage before kept."""
    read = lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet")
    docs = read("documents")
    columns = docs.columns
    steps = dict(corpus_pipeline.STAGES)
    assert list(steps) == ["toxicity", "exact_dedup", "near_dedup", "decontamination", "bpe"]
    ids = lambda df: {r["doc_id"] for r in df.select("doc_id").collect()}

    one = steps["toxicity"](spark, docs, sf_dir)
    scores = toxicity.score_documents(docs, toxicity.fit(docs, read("labels")))
    assert one.columns == columns and ids(one) == ids(scores.where("predicted = 0"))
    two = steps["exact_dedup"](spark, one, sf_dir)
    assert two.columns == columns and ids(two) == ids(exact.exact_groups(one).where("kept"))
    three = steps["near_dedup"](spark, two, sf_dir)
    assert three.columns == columns and ids(three) == ids(minhash.near_duplicates(two, percent=corpus_pipeline.NEAR_PERCENT).where("kept"))
    four = steps["decontamination"](spark, three, sf_dir)
    assert four.columns == columns and ids(four) == ids(three) - ids(decontam.contaminated(three, read("benchmark")))
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = {r["doc_id"]: len(library.encode(r["text"], add_special_tokens=False).ids) for r in four.collect()}
    assert {r["doc_id"]: r["n_tokens"] for r in corpus_pipeline.run(spark, sf_dir).collect()} == want


def test_every_operator_is_registered():
    numbers = sorted(int(re.match(r"op(\d+)_", name)[1]) for name in QUERIES)
    assert numbers == list(range(1, 14)) and set(ORACLE) <= set(QUERIES)
    found = __spark_entry__.queries()
    assert set(QUERIES) <= set(found) and "pipeline" in found


def test_near_stage_takes_four_fifths(spark, documents):
    """Pairs between 80 and 85 % go too, as every pair compared on word shingles says."""
    words = lambda n, changed: " ".join(f"x{i}" if i in changed else f"w{n}-{i}" for i in range(304))
    rows, want = [], set()
    for n, changed in enumerate([{20}, {20, 60, 100}, {20, 60, 100, 140, 180, 220}, {*range(20, 280, 40)}, {*range(20, 280, 20)}]):
        texts = {10 * n: words(n, ()), 10 * n + 1: words(n, changed)}
        one, two = ({tuple(t.split()[i : i + 5]) for i in range(300)} for t in texts.values())
        share = len(one & two) / len(one | two)
        rows += texts.items()
        want |= {10 * n} if share >= 0.8 else set(texts)
        assert n != 2 or 0.8 <= share < 0.85
    kept = dict(corpus_pipeline.STAGES)["near_dedup"](spark, documents(rows), "")
    assert {r["doc_id"] for r in kept.collect()} == want
    assert minhash.banding(85) == (6, 42) and minhash.banding(80) == (5, 51)
