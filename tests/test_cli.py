"""The command line over raw files, end to end."""

import pytest

from turnpress.__main__ import arguments, main
from turnpress.catalog import inputs
from turnpress.sources import io

SMALL = "/root/testdata/sf0.001"


def test_prepare_pack_plan(spark, tmp_path, capsys):
    raw, out, packed, plan = (str(tmp_path / n) for n in ("raw", "out", "packed", "plan"))
    inputs.raw_single_turn(spark, SMALL).drop("ord").write.parquet(f"{raw}/single")
    inputs.raw_multi_turn(spark, SMALL).drop("ord").write.parquet(f"{raw}/multi")
    command = ["prepare", "--single-turn", f"{raw}/single", "--multi-turn", f"{raw}/multi", "--file-order", "--output-dir", out]
    main(command)
    stats = {r["metric"]: r["value"] for r in io.read_stats(spark, f"{out}/stats").collect()}
    assert stats["single_turn_total"] == 1000 and stats["final_examples"] > 0
    main(command)
    assert "nothing to do" in capsys.readouterr().out

    main(["pack", "--examples", f"{out}/examples", "--out-dir", packed, "--seq-len", "4096", "--eval-size", "20"])
    train, held = io.read_packed(spark, packed)
    assert train.count() > 0 and held.count() <= 20

    table = ["pack", "--examples", f"{out}/table", "--format", "parquet", "--quoted-arguments", "--out-dir", f"{packed}2", "--seq-len", "4096", "--eval-size", "20"]
    main(table)
    assert io.read_packed(spark, f"{packed}2")[1].count() <= 20

    main(["plan", "--data-dir", packed, "--out-dir", plan, "--world-size", "2", "--global-batch-size", "4"])
    assert spark.read.parquet(plan).select("bin").distinct().count() <= train.count()


def test_one_source_and_cap(spark, tmp_path):
    raw, out = str(tmp_path / "raw"), str(tmp_path / "out")
    inputs.raw_single_turn(spark, SMALL).write.json(raw)
    main(["prepare", "--single-turn", raw, "--format", "json", "--single-turn-only", "--max-single-turn", "50", "--output-dir", out])
    stats = {r["metric"]: r["value"] for r in io.read_stats(spark, f"{out}/stats").collect()}
    assert stats["single_turn_total"] == 50 and stats["by_source_multi_turn"] == 0


def test_restrictions_exclude_each_other():
    with pytest.raises(SystemExit):
        arguments(["prepare", "--output-dir", "x", "--single-turn-only", "--multi-turn-only"])


def test_a_vocabulary_is_chosen_by_its_file(tmp_path):
    import public_tokenizers

    from turnpress.__main__ import arguments, tokenizer_of

    def chosen(*more):
        return tokenizer_of(arguments(["pack", "--examples", "x", "--out-dir", str(tmp_path), *more]))

    assert chosen() is None
    assert type(chosen("--tokenizer", public_tokenizers.path("byte_bpe_50k.tiktoken"), "--pad-id", "7")).__name__ == "VocabularyTokenizer"
    assert type(chosen("--tokenizer", public_tokenizers.path("word_bpe_49k.json"))).__name__ == "FileTokenizer"
