from __future__ import annotations

from shelfscan.__main__ import REPORTS, main, report


def test_build_and_every_report(spark, source_rows, tmp_path, capsys):
    export, root = str(tmp_path / "export"), str(tmp_path / "tables")
    source_rows(
        {
            "code": "7891",
            "nova_group": 4,
            "labels_tags": ["en:organic"],
            "brands": "Açaí",
            "nutriscore_grade": "a",
            "categories_tags": ["en:sodas"],
            "additives_tags": ["en:e450i"],
        }
    ).write.parquet(export)
    main(["build", export, root])
    main(["build", export, root, "--modified-after", "2999-01-01"])
    main(["report", "tile4_top_brands", root])
    assert "Açaí" in capsys.readouterr().out
    for name in sorted(REPORTS):
        rows = report(spark, name, root, "brazil").count()
        assert rows == (0 if name == "deceptive_brands" else 1)
