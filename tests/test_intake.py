import datetime as dt

from postline import fixed_values as fixed
from postline import schemas
from postline.sources import landing
from postline.streaming import intake

SCHEMA = schemas.LANDING[fixed.POSTS]


def test_each_landed_file_is_processed_once(spark, tmp_path):
    zone, done, state = (str(tmp_path / name) for name in ("zone", "done", "state"))

    def land(name, text, day):
        row = (text, 1, dt.datetime(2024, 1, day, 9), 2, "ann", day, None)
        landing.write_delimited(spark.createDataFrame([row], SCHEMA).coalesce(1), f"{zone}/{name}")

    def run():
        landed = intake.watch_landing(spark, f"{zone}/*", SCHEMA, files_per_batch=1)
        intake.process_landed(landed, done, state).awaitTermination()
        rows = intake.read_intake(spark, done, SCHEMA).orderBy("post_id").collect()
        return [(r.post_id, r.text, r.date.day) for r in rows]

    land("a", "See | https://t.co/x\nyou", 1)
    land("b", "Two!", 2)
    two = [(1, "see  \nyou", 1), (2, "two", 2)]
    assert run() == two
    assert run() == two
    land("c", "Three", 3)
    assert run() == [*two, (3, "three", 3)]


def overlapping(spark, tmp_path, *batches):
    """Each batch of (user, post_id, day collected, text) lands in files of its own and is run to its end; the rows, and the late ones."""
    root, schema = str(tmp_path), schemas.LANDING[fixed.POSTS]
    zone, done, late = landing.landing_path(root, fixed.POSTS), f"{root}/done", 0
    for n, batch in enumerate(batches):
        rows = [(text, 1, dt.datetime(2020, 1, 1), 0, user, i, dt.datetime(2024, 1, day)) for user, i, day, text in batch]
        frame = spark.createDataFrame(rows, schema).repartition(2)
        landing.write_delimited(frame, f"{root}/new{n}")
        for k, file in enumerate(sorted((tmp_path / f"new{n}").glob("*.csv"))):
            (tmp_path / "raw_data" / "TWEET_INFO.csv").mkdir(parents=True, exist_ok=True)
            (tmp_path / "raw_data" / "TWEET_INFO.csv" / f"{n}-{k}.csv").write_bytes(file.read_bytes())
        stream = intake.first_of_posts(intake.watch_landing(spark, zone, schema, files_per_batch=1), "3 days")
        query = intake.process_landed(stream, done, f"{root}/state")
        query.awaitTermination()
        late += intake.late_rows(query)
    found = intake.read_intake(spark, done, schema).collect()
    return sorted((r.user, r.post_id, r.text) for r in found), late


def test_overlapping_files_give_one_row_per_post(spark, tmp_path):
    """Copies in a file, over micro-batches, and over runs; old posts that are collected late in the day."""
    found, late = overlapping(
        spark, tmp_path,
        [("a", 1, 1, "x"), ("a", 1, 1, "x"), ("b", 1, 1, "y")],
        [("a", 1, 2, "x"), ("a", 2, 2, "z"), ("b", 1, 2, "y")],
        [("a", 2, 3, "z"), ("c", 1, 3, "w")],
    )
    assert found == [("a", 1, "x"), ("a", 2, "z"), ("b", 1, "y"), ("c", 1, "w")] and late == 0


def test_posts_collected_too_late_are_dropped_and_counted(spark, tmp_path):
    found, late = overlapping(spark, tmp_path, [("a", 1, 10, "x")], [("a", 2, 12, "y")], [("b", 1, 2, "old"), ("b", 2, 12, "new")])
    assert found == [("a", 1, "x"), ("a", 2, "y"), ("b", 2, "new")] and late == 1
