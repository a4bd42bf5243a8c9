import corpus_pipeline
from compare import SF
from eventloom.llm.queries import tokenizer_path
from helpers import docs
from test_dedup import classes, print_of
from test_scans import brute


def test_stages_against_brute_force(spark):
    """Each stage on what the one before has kept, against a plain version of it."""
    read = lambda name: spark.read.parquet(f"{SF}/{name}.parquet")
    df, columns = read("documents"), read("documents").columns
    scored = {}
    from eventloom.llm.queries import op7_quality

    scored = {r.doc_id for r in op7_quality(spark, SF).collect() if r.predicted == 1}
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert len(names) == 5
    steps = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        df = spark.createDataFrame(stage(spark, df, SF).collect(), read("documents").schema)
        assert df.columns == columns
        steps[name] = {r.doc_id: r.text for r in df.collect()}
    first, second, third, fourth = steps.values()
    assert set(first) == scored
    low = {}
    for i, t in first.items():
        key = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
        low[key] = max(i, low.get(key, i))
    assert set(second) == set(low.values())
    assert set(third) == set(classes({i: print_of(t) for i, t in second.items()}).values())
    items = [(r.item_id, r.text) for r in read("benchmark").collect()]
    order = sorted(third)
    assert set(fourth) == {order[b[0]] for b in brute([third[i] for i in order], items) if not b[-1]}
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(tokenizer_path())
    last = corpus_pipeline.STAGES[-1][1](spark, df, SF).collect()
    assert {r.doc_id: r.ids for r in last} == {i: t.encode(x, add_special_tokens=False).ids for i, x in fourth.items()} and all(r.round_trip for r in last)
    # What held for the stages one by one holds for the run.
    assert sorted(map(tuple, corpus_pipeline.run(spark, SF).collect())) == sorted(map(tuple, last))


def test_run(spark):
    out = corpus_pipeline.run(spark, SF)
    assert out.columns == ["doc_id", "n_tokens", "ids", "round_trip"] and 0 < out.count() < spark.read.parquet(f"{SF}/documents.parquet").count()


def test_stages_of_odd_rows(spark):
    odd = docs(spark)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, odd, SF)
        assert kept.columns == odd.columns and kept.count() <= odd.count()
    assert corpus_pipeline.STAGES[-1][1](spark, odd, SF).count() == odd.count()
