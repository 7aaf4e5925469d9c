import glob
import os

from fixtures import Q1_EXPECTED, Q2_RANK_COMBINED, Q3_LOOSE, Q4_EXPECTED
from files import write_blocks, write_crime_files, write_income, write_stations

from urbanlens.cli import main


def _read(path):
    rows = []
    for part in sorted(glob.glob(os.path.join(path, "part-*"))):
        with open(part) as fh:
            rows += [line.split(",") for line in fh.read().splitlines()]
    return rows


def test_every_question_from_files(spark, tmp_dir):
    crimes = write_crime_files(tmp_dir)
    out = os.path.join(tmp_dir, "q1")
    main(["share", "--crimes", *crimes, "--output", out], spark)
    assert [(p, float(v)) for p, v in _read(out)] == Q1_EXPECTED

    out = os.path.join(tmp_dir, "q2")
    main(["months", "--crimes", *crimes, "--output", out], spark)
    assert [tuple(map(int, r)) for r in _read(out)] == Q2_RANK_COMBINED

    out = os.path.join(tmp_dir, "q3")
    main(["area", "--blocks", write_blocks(tmp_dir), "--income", write_income(tmp_dir),
          "--join", "merge", "--output", out], spark)
    rows = sorted(((z, float(v) if v else None) for z, v in _read(out)), key=lambda r: (r[0], r[1] or -1))
    assert rows == Q3_LOOSE

    out = os.path.join(tmp_dir, "q4")
    main(["nearest", "--crimes", *crimes, "--stations", write_stations(tmp_dir),
          "--order-column", "PREC", "--output", out], spark)
    assert {d: (float(a), int(n)) for d, a, n in _read(out)} == Q4_EXPECTED


def test_conversion_then_parquet_query(spark, tmp_dir):
    crimes = write_crime_files(tmp_dir)
    main(["to-parquet", "--crimes", *crimes, "--out", os.path.join(tmp_dir, "pq")], spark)
    parquet = sorted(glob.glob(os.path.join(tmp_dir, "pq", "*.parquet")))
    df = main(["share", "--crimes", *parquet, "--format", "parquet"], spark)
    assert [tuple(r) for r in df.collect()] == Q1_EXPECTED


def test_months_per_source_forms(spark, tmp_dir):
    from fixtures import Q2_ROW_NUMBER_PER_SOURCE

    crimes = write_crime_files(tmp_dir)
    for flags in (["--sql"], ["--per-source", "--ties", "row_number"]):
        df = main(["months", "--crimes", *crimes, *flags], spark)
        assert [tuple(r) for r in df.collect()] == Q2_ROW_NUMBER_PER_SOURCE, flags


def test_explain_and_single_file(spark, tmp_dir, capsys):
    out = os.path.join(tmp_dir, "one")
    main(["area", "--blocks", write_blocks(tmp_dir), "--income", write_income(tmp_dir), "--explain", "--single-file",
          "--output", out], spark)
    assert "Physical Plan" in capsys.readouterr().out
    assert len(glob.glob(os.path.join(out, "part-*"))) == 1


def test_one_split_collection_and_headers_of_their_own(spark, tmp_dir):
    folder = os.path.join(tmp_dir, "income")
    os.mkdir(folder)
    write_income(folder)
    df = main(["area", "--blocks", write_blocks(tmp_dir), "--split", "--income", folder, "--own-headers"], spark)
    assert sorted(map(tuple, df.collect()), key=lambda r: (r[0], r[1] or -1)) == Q3_LOOSE
