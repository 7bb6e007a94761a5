import json

import pytest
from pyspark.sql import functions as F

from linkforge import cli
from linkforge.plans import adapters
from linkforge.sources import tables


def test_commands(spark, sf_dir, tmp_path, capsys):
    e = adapters.document_entities(spark, sf_dir)
    for i in (1, 2, 3):
        tables.write_tsv(e.where(F.col("entity_id").startswith(f"S{i}-")).select(*tables.ENTITY).coalesce(1), str(tmp_path / f"train_source{i}.tsv"))
    lists = adapters.truth_of(e).groupBy("q_id").agg(F.array_join(F.collect_list("t_id"), ",").alias("matched_entity_ids")).withColumnRenamed("q_id", "source1_entity_id")
    tables.write_tsv(lists.coalesce(1), str(tmp_path / "train_ground_truth.tsv"))
    base = ["--data-dir", str(tmp_path), "--candidates", str(tmp_path / "c"), "--model", str(tmp_path / "m")]
    cli.main(["retrieve", *base, "--out", str(tmp_path / "c"), "--top-k", "10"])
    cli.main(["evaluate", *base])
    assert json.loads(capsys.readouterr().out)["links_found"] == 5
    cli.main(["train", *base])
    cli.main(["predict", *base, "--out", str(tmp_path / "p")])
    cli.main(["validate", *base, "--matching", str(tmp_path / "p")])
    assert capsys.readouterr().out.startswith("PASS")
    said = lambda *more: (cli.main([*more, *base]), json.loads(capsys.readouterr().out.strip().splitlines()[-1]))[1]
    scored = said("score", "--matching", str(tmp_path / "p"), "--report", str(tmp_path / "r.json"))
    assert scored["validation_entities"] == 67 and json.loads((tmp_path / "r.json").read_text()) == scored
    assert said("misses")["examples"] == [] and len(said("baseline")) == 10 and said("audit")
    assert said("index", "--index", str(tmp_path / "i"))["targets"] == 133
    found = said("experiments", "--kinds", "logistic,logistic")
    assert len(found["sweeps"]) == 26 and found["best"]["position"] == 0
    # a wrong header, and rows that are not there
    (tmp_path / "bad").write_text("source1_entity_id\tids\nS1-3\tS2-4\n", encoding="utf-8")
    cli.main(["validate", *base, "--matching", str(tmp_path / "bad")])
    out = capsys.readouterr().out
    assert out.startswith("FAIL") and '"check": "header", "n": 1' in out
    with pytest.raises(ValueError, match="header"):
        cli.main(["score", *base, "--matching", str(tmp_path / "bad")])
