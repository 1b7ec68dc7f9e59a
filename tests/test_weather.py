import json

from hourmart.sources import weather_documents as wd
from tests.helpers import rows, ts

TEXT = """# BRON: station
# STN = station number
# STN,YYYYMMDD,    H,   T,   FH,    Q

  260,20260824,    1,   50,  100,   20
  260,20260824,   24,  -15,     ,   -1
"""


def expected():
    return [
        (260, ts("2026-08-24 01:00"), 5.0, 10.0, 200000.0),
        (260, ts("2026-08-25 00:00"), -1.5, None, 0.0),
    ]


def test_station_document(spark):
    docs = spark.createDataFrame([("a", TEXT)], "doc string, content string")
    lines = wd.lines_of_documents(docs, "content", ["doc"])
    assert rows(wd.station_rows(lines)) == expected()


def test_station_files_keep_the_last_file(spark, tmp_path):
    (tmp_path / "a_2010-2019.txt").write_text(TEXT)
    later = TEXT.replace("   50,", "   70,").replace("# STN,YYYYMMDD,    H,   T,   FH,    Q", "# STN,YYYYMMDD,H,FH,T,Q")
    (tmp_path / "a_2020-2029.txt").write_text(later)
    paths = wd.decade_paths(str(tmp_path / "a_{decade}.txt"), 2015, 2024)
    got = rows(wd.station_files(spark, paths))
    # The second file has its columns in another order.
    assert got[0] == (260, ts("2026-08-24 01:00"), 10.0, 7.0, 200000.0)
    assert len(got) == 2


def test_decades_in_between_are_read():
    assert wd.decade_paths("x_{decade}", 1999, 2021) == ["x_1990-1999", "x_2000-2009", "x_2010-2019", "x_2020-2029"]


def grid(spark, times, temps, winds, rads):
    payload = {"hourly": {"time": times, "temperature_2m": temps, "wind_speed_10m": winds, "shortwave_radiation": rads}}
    docs = spark.createDataFrame([("a", json.dumps(payload))], "doc string, content string")
    out = wd.grid_rows(wd.parse_json(docs, "content", ["doc"]), ["doc"])
    return rows(out, "interval_end_local", "temp_c", "wind_ms", "radiation_jm2")


def test_grid_units_and_labels(spark):
    got = grid(
        spark,
        ["2026-08-24T22:00", "2026-01-15T22:00", "2026-01-15T23:00"],
        [20.5, None, None],
        [18.0, 3.6, None],
        [500.0, None, None],
    )
    assert got == [
        (ts("2026-01-16 00:00"), None, 1.0, None),
        (ts("2026-08-25 01:00"), 20.5, 5.0, 1800000.0),
    ]


def test_repeated_autumn_label_keeps_the_later_hour(spark):
    times = ["2025-10-25T23:00", "2025-10-26T00:00", "2025-10-26T01:00"]
    got = grid(spark, times, [1.0, 2.0, 3.0], [None] * 3, [None] * 3)
    assert [(label, t) for label, t, _, _ in got] == [
        (ts("2025-10-26 02:00"), 2.0),
        (ts("2025-10-26 03:00"), 3.0),
    ]


def test_files_without_header_are_told(spark, tmp_path):
    (tmp_path / "bad.txt").write_text("260,20260101,1,10\n260,20260101,2,11\n")
    lines = wd.lines_of_files(spark, [str(tmp_path / "bad.txt")])
    assert [r["n_lines"] for r in wd.headerless(lines).collect()] == [2]
    assert wd.station_rows(lines).collect() == []
