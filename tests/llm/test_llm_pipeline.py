"""The five stages against plain versions, each on what the stage before it returned."""

import tiktoken
from conftest import SF
from test_llm_texts import brute_components, cut_lines

import corpus_pipeline
from cartwheel.llm import bpe, mixing
from cartwheel.llm.queries import mixing_attributes, rank_file
from cartwheel.scratch import write_table


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, before = docs.columns, {r.doc_id: r for r in docs.collect()}
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    for name, stage in corpus_pipeline.STAGES:
        docs = write_table(stage(spark, docs, SF), f"test-{name}")
        after = {r.doc_id: r for r in docs.collect()}
        assert after.keys() <= before.keys() and len(after) == docs.count()
        if name != "bpe":
            assert docs.columns == columns
        if name == "toxicity":
            clean = {k for k in before if labels.get(k) == 0}
            assert len(clean & after.keys()) >= 0.98 * len(clean)
        if name == "line_dedup":
            cut = cut_lines(sorted((k, r.text) for k, r in before.items()))
            kept = {k for k, t in cut.items() if t.strip() or not before[k].text.strip()}
            assert {k: r.text for k, r in after.items()} == {k: cut[k] for k in kept}
        if name == "ngram_join":
            found = brute_components([(k, r.text) for k, r in before.items()], 5, 80)
            assert after.keys() == {k for k, (_, c) in found.items() if c == k}
        if name == "mixing":
            assert 0 < len(after) < len(before)
        if name == "bpe":
            path, pattern = rank_file()
            library = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=bpe.read_ranks(path), special_tokens={})
            for k, r in after.items():
                assert r.round_trip and r.n_tokens == len(library.encode_ordinary(before[k].text)) == len(r.ids) // 4
        before = after


def test_a_missing_part_of_a_table(spark):
    """NULL ids and texts pass through all stages."""
    rows = [(1, None, None, None, None), (None, "x y z", "en", "s", 5), (2, "", "en", "s", 0), (2, "", "en", "s", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for _, stage in corpus_pipeline.STAGES:
        docs = write_table(stage(spark, docs, SF), "test-odd")
    assert docs.count() <= len(rows)


def test_one_row_of_repeated_ids(spark):
    """Equal texts under one id leave one row; so do copies that share an id with another text."""
    long = " ".join(f"w{k}" for k in range(30))
    rows = [(5, long), (5, long), (5, long.upper()), (3, "a b c d e f"), (3, "g h i j k l"), (4, "a b c d e f"), (4, "only this one here"), (2, ""), (2, ""), (None, "x"), (None, "x")]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    left = corpus_pipeline.one_of_each_group(spark, docs, SF).collect()
    found = sorted(((r.doc_id or 0, r.text) for r in left))
    assert found == sorted([(5, min(long, long.upper())), (3, "a b c d e f"), (3, "g h i j k l"), (4, "only this one here"), (2, ""), (0, "x"), (0, "x")])


CLASHES = ["_cls", "_toxicity", "__line_id", "__line_key", "__line_spans", "__line_lines", "_lines_removed", "_kept", "_by_source", "_row", "score", "cls", "rows", "component_id", "beside_0"]


def test_columns_with_clashing_names(spark):
    """Every stage gives back what stood beside the documents as it was."""
    long = " ".join(f"w{k}" for k in range(40))
    rows = [(1, long, "en", "a", 1), (2, long, "en", "a", 1), (3, "a b\n" * 9, "de", "b", 2), (3, "a b\n" * 9, "de", "b", 2), (4, None, None, None, None), (None, "x", "en", "a", 1)]
    rows += [(100 + k, f"document {k} says {k * 7} things about {k * k}", "en", "ab"[k % 2], 9) for k in range(40)]
    rows = [(*r, *[f"{n}-{r[0]}" for n in CLASHES]) for r in rows]
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{n}` string" for n in CLASHES)
    docs = spark.createDataFrame(rows, schema)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = write_table(stage(spark, docs, SF), f"test-clash-{name}")
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars", *CLASHES], name
        after = docs.collect()
        assert after and all(r[n] == f"{n}-{r.doc_id}" for r in after for n in CLASHES), name
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SF).count() == docs.count()


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long, _cls int")
    for name, stage in corpus_pipeline.STAGES:
        docs = write_table(stage(spark, docs, SF), f"test-empty-{name}")
        assert docs.count() == 0


def test_mixing_meets_its_targets(spark):
    """Expected shares of source, language and topic equal the tempered ones."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    mixed = mixing.mix(docs, "doc_id", "text", mixing_attributes(), meet=True).toPandas()
    words = mixed.text.str.split().str.len()
    held = words * mixed._keep_probability
    for name in mixing_attributes():
        tempered = words.groupby(mixed[f"_by_{name}"]).sum() ** mixing.TEMPERATURE
        shares = held.groupby(mixed[f"_by_{name}"]).sum() / held.sum()
        assert abs(shares - tempered / tempered.sum()).max() < 1e-3


def test_raking_takes_as_many_tasks_as_the_cells_call_for(spark, monkeypatch):
    """Sweeps over few cells shuffle nothing, and over many in several tasks come to the same weights."""
    rows = [(a, b, 10 * (1 + a) + 7 * b) for a in range(4) for b in range(5)]
    cells = spark.createDataFrame(rows, "a int, b int, tokens long")
    targets = {n: mixing.tempered(cells, n, "tokens", 0.5) for n in ("a", "b")}
    plans, write = [], mixing.write_table

    def written(df, name, schema=None):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return write(df, name, schema)

    monkeypatch.setattr(mixing, "write_table", written)
    weights = {}
    for most in (200_000, 6):
        monkeypatch.setattr(mixing, "CELLS_PER_TASK", most, raising=False)
        plans.clear()
        weights[most] = {(r.a, r.b): r.weight for r in mixing.rake(cells, ["a", "b"], "tokens", targets, 12, within=1e-12).collect()}
        assert len(plans) > 2 and all("Window" in p and ("Exchange" in p) == (most == 6) for p in plans[1:])
    one, several = weights.values()
    assert one.keys() == several.keys() and all(abs(one[k] - several[k]) < 1e-12 for k in one)
