"""Plans of the near-duplicate join."""

from tessera.llm import jaccard_join
from tessera.llm.jaccard_join import _prefix


def test_nothing_costly_is_computed_per_generated_row(llm_spark):
    """Columns beside a generator are evaluated for each row it makes, so the set is only cut there."""
    schema = "node long, n long, set array<struct<rarity: int, h: long>>, bits struct<b0: long, b1: long, b2: long, b3: long>"
    ordered = llm_spark.createDataFrame([(1, 10, [(1, 5), (2, 6), (2, 9)], (1, 2, 3, 4))], schema)
    plan = _prefix(ordered)._jdf.queryExecution().optimizedPlan().toString()
    above = plan[: plan.index("Generate")]
    assert "aggregate" not in plan and "bit_xor" not in plan and "lambda" not in above
    assert [(r["h"], r["rest"], r["lone"]) for r in _prefix(llm_spark.createDataFrame([(1, 3, [(1, 5), (2, 6), (2, 9)], (1, 2, 3, 4))], schema)).collect()] == [(5, 3, 0)]


def test_first_parts_are_hashed_once(llm_spark, monkeypatch):
    """The classes, their tokens and the result read one stored table; whole sets are made of the sieved texts only."""
    made, sets = [], jaccard_join._sets

    def counted(docs, first_part):
        out = sets(docs, first_part)
        made.append((first_part, out))
        return out

    kept, store = [], jaccard_join.stored

    def storing(df, kind):
        if kind in ("parts", "kept", "keys"):
            kept.append((kind, df._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow")))
        return store(df, kind)

    monkeypatch.setattr(jaccard_join, "_sets", counted)
    monkeypatch.setattr(jaccard_join, "stored", storing)
    text = " ".join(f"w{i}" for i in range(60))
    docs = llm_spark.createDataFrame([(1, text), (2, text + " more"), (3, "short one"), (4, None)], "doc_id long, text string")
    got = {r["doc_id"]: r["component_id"] for r in jaccard_join.jaccard_components(docs).collect()}
    assert got == {1: 1, 2: 1, 3: 3, 4: 4}
    assert [first for first, _ in made].count(True) == 1
    assert dict(kept) == {"parts": 1, "kept": 0}
