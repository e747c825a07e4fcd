import csv
import random

import pytest

from tabwright.sources import readers

BITS = ["a", ",", '"', "\n", "\n\n", " ", "é", "x\ny", '""', "日本", "1"]


def rows_of(seed, n, longest):
    rng = random.Random(seed)
    out = [[str(i), "".join(rng.choice(BITS) for _ in range(rng.randrange(longest))) + "z", "t"] for i in range(n)]
    return out + [[str(n), "long\n" * 300 + "end", "t"]]


@pytest.mark.parametrize("split", [150, 3000, 1 << 27])
def test_records_over_any_split(spark, tmp_path, split):
    data = {f: rows_of(i, 25, 40) for i, f in enumerate(("a.csv", "b.csv"))}
    for f, rows in data.items():
        with open(tmp_path / f, "w", newline="", encoding="utf-8") as out:
            w = csv.writer(out, quoting=csv.QUOTE_MINIMAL, lineterminator="\n")
            w.writerows([["id", "text", "tag"], *rows])
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(split))
    try:
        df = readers.read_text(spark, str(tmp_path), multi_line=True)
        got = sorted((r["id"], r["text"], r["tag"], r[readers.SURPLUS]) for r in df.collect())
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert got == sorted((*r, None) for rows in data.values() for r in rows)


def test_surplus_short_and_blank_rows(spark, tmp_path):
    (tmp_path / "x.csv").write_text('id,text\r\n1,"a\nb"\r\n\r\n2\r\n3,c,"more\n,"\r\n')
    got = {r["id"]: (r["text"], r[readers.SURPLUS]) for r in readers.read_text(spark, str(tmp_path / "x.csv"), multi_line=True).collect()}
    assert got == {"1": ("a\nb", None), "2": (None, None), "3": ("c", "more\n,")}
    (tmp_path / "y.csv").write_text("id,text\n")
    assert readers.read_text(spark, str(tmp_path / "y.csv"), multi_line=True).count() == 0
    with pytest.raises(FileNotFoundError):
        readers.read_text(spark, str(tmp_path / "none.csv"), multi_line=True)
