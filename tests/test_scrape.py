"""The scrape source over snapshots that come, fail to come, and come between restarts."""

from ledgerlens.sources.scrape import ScrapeSource, samples_of
from ledgerlens.streaming.io import read_batches, start_table

BASE = 1_704_067_200  # a full hour


def put(folder, job, second, text):
    at = BASE + second
    where = folder / f"job={job}" / f"hour={at // 3600}"
    where.mkdir(parents=True, exist_ok=True)
    (where / f"{at}.prom").write_text(text)


def test_lines_of_a_snapshot():
    text = '# HELP a\n# TYPE a counter\na 1\nb{x="1 2",y="}"} 2.5 1700\nc nan\n\nbroken\nd x\ne_total{} 1e3\n'
    got = list(samples_of(text))
    assert [g[:2] for g in got] == [("a", ""), ("b", 'x="1 2",y="}"'), ("c", ""), ("e_total", "")] and [got[1][2], got[3][2]] == [2.5, 1000.0]


def test_a_restart_loses_and_repeats_nothing(spark, tmp_path):
    spark.dataSource.register(ScrapeSource)
    source = tmp_path / "in"

    def run():
        stream = spark.readStream.format("scrape").option("interval", 10).option("hours", 1).load(str(source))
        start_table(stream, str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()

    for second in (3, 8, 19, 3595):  # the scrape at 10 takes the snapshot of 8
        put(source, "a", second, f"n {second}")
    put(source, "b", 25, "m 1")
    run()
    run()  # nothing new
    put(source, "a", 3601, "n 3601")
    put(source, "a", 3625, "n 3625")
    put(source, "b", 3620, "m 2")
    run()
    rows = [(r["job"], int(r["at"].timestamp()) - BASE, r["name"], r["value"], r["stale"]) for r in read_batches(spark, str(tmp_path / "out")).collect()]
    assert len(rows) == len(set(rows))
    hits = {"a": {10: 8, 20: 19, 3600: 3595, 3610: 3601}, "b": {30: 1, 3620: 2}}
    want = set()
    for job, first, name in (("a", 10, "n"), ("b", 30, "m")):
        for at in range(first, 3621, 10):
            hit = hits[job].get(at)
            want.add((job, at, "up", 1.0 if hit else 0.0, hit is None))
            if hit:
                want.add((job, at, name, float(hit), False))
    assert set(rows) == want
