import datetime as dt
import json
import os
import subprocess
import sys
import uuid
from pathlib import Path

import pytest

from postline import __main__ as command
from postline.plans import daily
from tests.plans import initial_plan

REPO = Path(__file__).resolve().parents[1]


def collected(user, followers, *posts, hour=None):
    """Posts are (id, day of January, likes, text, id of the original of a repost)."""
    at = lambda day: f"2024-01-{day:02d} 10:00:00+00:00"
    return {
        "user": user,
        "collected_at": hour and f"2024-01-31 {hour:02d}:00:00+00:00",
        "TWEET_INFO": {
            "text": [p[3] for p in posts],
            "favorite_count": [p[2] for p in posts],
            "retweet_count": [0 for _ in posts],
            "created_at": [at(p[1]) for p in posts],
            "post_id": [p[0] for p in posts],
            "repost_of": [p[4] for p in posts],
        },
        "USER_INFO": {
            "followers_count": followers,
            "following_count": 2,
            "created_at": at(1),
            "description": "a|b\nc",
        },
        "USER_ACTIVITY": {"favoris_count": 11, "retweet_count": 12},
    }


def payload(path, *accounts):
    path.write_text("\n".join(json.dumps(a) for a in accounts))
    return str(path)


@pytest.fixture
def run(spark, tmp_path):
    db = f"d_{uuid.uuid4().hex}"

    def run(day, *accounts, **options):
        path = payload(tmp_path / f"{uuid.uuid4().hex}.json", *accounts) if accounts else None
        done = daily.run_day(spark, path, str(tmp_path / "root"), db, dt.date(2024, 1, day), **options)
        posts = spark.table(f"{db}.tweets").orderBy("id").collect()
        users = spark.table(f"{db}.users").orderBy("user").collect()
        days = spark.table(f"{db}.user_snapshots").orderBy("date", "user").collect()
        return done, posts, users, days

    run.root = tmp_path / "root"
    return run


ANN = (1, 19, 5, "@x See https://t.co/a1 | now", None)


def test_days(run):
    done, posts, users, days = run(
        20, collected("ann", 7, (2, 20, 1, "two", None), ANN, (3, 20, 1, "rt", 99)), collected("old", 1, (4, 3, 1, "x", None))
    )
    assert done
    assert [(p.id, p.user, p.post_id, p.text, p.favorite_count, p.date.day) for p in posts] == [
        (1, "old", 4, "x", "1", 3),
        (2, "ann", 1, "x see   now", "5", 19),
        (3, "ann", 2, "two", "1", 20),
    ]
    day = dt.date(2024, 1, 20)
    assert [tuple(u) for u in users] == [
        ("ann", "a|b\nc", "2", "7", "11", "12", dt.date(2024, 1, 1), day),
        ("old", "a|b\nc", "2", "1", "11", "12", dt.date(2024, 1, 1), day),
    ]

    # Nothing newer than the 20th: skipped, though the likes changed.
    assert run(21, collected("ann", 8, (2, 20, 9, "two", None)))[0] is False

    # A newer post opens the whole timeline: known posts are updated, not added.
    done, posts, users, days = run(
        22, collected("ann", 9, (5, 22, 0, "five", None), (2, 20, 4, "two", None)), collected("bob", 3, (6, 22, 0, "six", None))
    )
    assert done
    assert [(p.id, p.post_id, p.favorite_count) for p in posts] == [
        (1, 4, "1"), (2, 1, "5"), (3, 2, "4"), (4, 5, "0"), (5, 6, "0")
    ]
    assert [(u.user, u.followers) for u in users] == [("ann", "9"), ("bob", "3"), ("old", "1")]
    assert [(d.date.day, d.user, d.followers) for d in days] == [
        (20, "ann", "7"), (20, "old", "1"), (22, "ann", "9"), (22, "bob", "3")
    ]


def test_a_day_run_again_changes_nothing(run):
    account = collected("ann", 7, ANN, (2, 20, 1, "two", None))
    first = run(20, account)
    again = run(20, account)
    assert again[0] is False and again[1:] == first[1:]


def test_two_runs_on_one_day_add_up(run):
    run(20, collected("ann", 7, ANN, (2, 20, 1, "two", None)))
    done, posts, users, days = run(20, collected("bob", 3, (6, 20, 0, "six", None)))
    assert done and len(posts) == 3
    assert [(u.user, u.followers) for u in users] == [("ann", "7"), ("bob", "3")]
    assert [(d.date.day, d.user) for d in days] == [(20, "ann"), (20, "bob")]


def test_an_interrupted_load_is_finished_by_the_next_run(run, monkeypatch):
    account = collected("ann", 7, ANN, (2, 20, 1, "two", None))
    with monkeypatch.context() as patch:
        def fail(*_):
            raise OSError("lost")

        patch.setattr(daily.post_table, "load_posts", fail)
        with pytest.raises(OSError):
            run(20, account)
    done, posts, users, days = run(20, account)
    assert done and len(posts) == 2 and len(users) == 1 and len(days) == 1


@pytest.mark.parametrize(
    ("place", "name", "call"),
    [
        ("tables", "_overwrite_partitions", 2),  # accounts loaded in part
        ("post_table", "load_posts", 1),  # accounts loaded, posts not
        ("post_table", "_write_commit", 1),  # posts written, not committed
        ("post_table", "_show", 2),  # committed, not shown; the first call shows the empty table
    ],
)
def test_a_broken_off_run_is_completed_by_the_next_with_another_payload(run, monkeypatch, place, name, call):
    """The next payload has nothing of what was collected before, and nothing of it is lost."""
    place, calls = getattr(daily, place), []
    real = getattr(place, name)

    def fail(*args):
        calls.append(args)
        if len(calls) == call:
            raise OSError("lost")
        return real(*args)

    with monkeypatch.context() as patch:
        patch.setattr(place, name, fail)
        with pytest.raises(OSError):
            run(20, collected("ann", 7, ANN, (None, 20, 1, "no id", None)))
    done, posts, users, days = run(21, collected("bob", 3, (6, 21, 0, "six", None)))
    assert done and [(p.user, p.post_id) for p in posts] == [("ann", 1), ("ann", None), ("bob", 6)]
    assert [(d.date.day, d.user) for d in days] == [(20, "ann"), (21, "bob")] and len(users) == 2


def test_no_more_than_fifty_posts_per_account(run):
    many = [(i, 20, 0, "t", None) for i in range(60)]
    _, posts, _, _ = run(20, collected("ann", 1, *many))
    assert sorted(p.post_id for p in posts) == list(range(10, 60))


@pytest.mark.parametrize(("newest", "kept"), [(3, 3), (None, 60)])
def test_another_number_of_posts(run, newest, kept):
    many = [(i, 20, 0, "t", None) for i in range(60)]
    assert len(run(20, collected("ann", 1, *many), newest=newest)[1]) == kept


def test_posts_without_id_all_stay_though_another_account_is_collected_twice(run):
    ten = [(None, 20, i, "t", None) for i in range(10)]
    bob = collected("bob", 1, (1, 20, 0, "b", None))
    _, posts, _, _ = run(20, collected("ann", 1, *ten), bob, bob)
    assert sorted(p.favorite_count for p in posts if p.user == "ann") == [str(i) for i in range(10)]
    assert [p.id for p in posts] == list(range(1, 12))


def test_the_later_collection_stands_though_its_counts_are_smaller(run):
    later = collected("ann", 90, (1, 20, 3, "new", None), hour=9)
    later["USER_ACTIVITY"] = {"favoris_count": 1, "retweet_count": 2}
    _, posts, users, _ = run(20, later, collected("ann", 100, (1, 20, 5, "old", None), hour=8))
    assert [(p.favorite_count, p.text) for p in posts] == [("3", "new")]
    assert [(u.followers, u.favorite_count, u.retweet_count) for u in users] == [("90", "1", "2")]


def test_bare_files_of_one_account(spark, run):
    """Landing files as another collector writes them, one row of them cut off."""
    zone = run.root / "raw_data"
    zone.mkdir(parents=True)
    (zone / "TWEET_INFO.csv").write_text(
        'text|favorite_count|date_creation|retweet_count\n"a ""b""\n|c"|3|2024-01-20 10:00:00+00:00|4\ncut off|5\nd|x|2024-01-19 10:00:00+00:00|1\n'
    )
    (zone / "USER_INFO.csv").write_text("followers|following|date_creation|description\n7|8|2020-01-01 00:00:00+00:00|me\n")
    (zone / "USER_ACTIVITY.csv").write_text("favorite_count|retweet_count\n5|6\n")
    done, posts, users, _ = run(20, account="ann")
    assert done
    assert sorted((p.text, p.favorite_count, p.user, p.post_id) for p in posts) == [
        ("a b\nc", "3", "ann", None), ("cut off", "5", "ann", None), ("d", None, "ann", None)
    ]
    assert sorted(p.id for p in posts) == [1, 2, 3]
    assert [(u.user, u.followers, u.favorite_count, u.retweet_count) for u in users] == [("ann", "7", "5", "6")]
    rejected = spark.read.text(str(run.root / "rejected" / "TWEET_INFO")).collect()
    assert sorted(r.value for r in rejected) == ["cut off|5", "d|x|2024-01-19 10:00:00+00:00|1"]


def test_an_account_collected_again_and_again(run):
    """Copies neither take the place of other posts nor multiply the account."""
    newest = [(i, 20, i, "t", None) for i in range(30)]
    older = [(i, 19, 0, "t", None) for i in range(30, 50)]
    copies = [
        collected("ann", n, *((i, d, likes + n, t, o) for i, d, likes, t, o in newest), hour=n) for n in (3, 1, 2)
    ]
    _, posts, users, days = run(20, *copies, collected("ann", 0, *older))
    assert {p.post_id: p.favorite_count for p in posts} == {
        **{i: str(i + 3) for i in range(30)}, **{i: "0" for i in range(30, 50)}
    }
    assert [(u.user, u.followers) for u in users] == [("ann", "3")] and len(days) == 1


def test_command_line(tmp_path):
    """Each step in its own process finds what the last one left."""
    path = payload(tmp_path / "p.json", collected("ann", 7, (2, 20, 1, "two", None)))
    root = str(tmp_path / "root")
    script = (
        "import sys; from postline.__main__ import main; from postline.session import build_session;"
        f"s = build_session(spark__master='local[2]', spark__sql__shuffle__partitions=2, spark__ui__enabled='false',"
        f" spark__checkpoint__dir='{tmp_path}/shared');"
        "[main([step, '--root', sys.argv[1], '--payload', sys.argv[2], '--as-of', '2024-01-20']) for step in sys.argv[3:]];"
        "print('posts', s.table('timelines.tweets').count(), s.table('timelines.users').count())"
    )

    def steps(*names):
        done = subprocess.run(
            [sys.executable, "-c", script, root, path, *names],
            cwd=tmp_path, env=os.environ | {"PYTHONPATH": str(REPO)}, capture_output=True, text=True, timeout=300,
        )
        assert done.returncode == 0, done.stderr[-2000:]
        return done.stdout.splitlines()

    assert steps("land", "transform", "load") == ["processed", "posts 1 1"]
    assert steps("daily") == ["nothing new", "posts 1 1"]


def test_command_line_needs_a_payload(capsys):
    with pytest.raises(SystemExit):
        command.main(["daily", "--root", "r"])
    assert "needs --payload" in capsys.readouterr().err


def stored_frames(monkeypatch, *modules):
    """The frames that are stored on the way, by name, the last of each."""
    staged = {}

    def watch(real):
        def keep(df, name):
            staged[name] = real(df, name)
            return staged[name]

        return keep

    for module in modules:
        monkeypatch.setattr(module, "stage", watch(module.stage))
    return staged


def test_texts_of_posts_are_not_stored_on_the_way(run, monkeypatch):
    """They go from the payload to the landing, processed and table files, and nowhere else."""
    staged = stored_frames(monkeypatch, daily, daily.post_table)
    run(20, collected("ann", 7, ANN, (2, 20, 1, "two", None)))
    _, posts, _, _ = run(22, collected("ann", 9, (5, 22, 0, "five", None), (2, 20, 4, "two", None)), newest=None)
    assert [p.text for p in posts] == ["x see   now", "two", "five"]
    assert {"payload", "landed_tweet_info", "placed_posts"} <= set(staged)
    for name, frame in staged.items():
        if name == "payload":
            assert all(set(row[0]) == {None} for row in frame.select("TWEET_INFO.text").collect())
        else:
            assert "text" not in frame.columns, name


def test_texts_are_shuffled_for_copies_only(spark, run, monkeypatch):
    plans = []
    real = daily.landing.write_landing
    monkeypatch.setattr(
        daily.landing, "write_landing", lambda df, root, table: plans.append(initial_plan(df)) or real(df, root, table)
    )
    run(20, collected("ann", 7, ANN, (2, 20, 1, "two", None)), newest=None)
    assert "Exchange" not in plans[0]
    _, posts, _, _ = run(22, *(collected("ann", 7, (3, 22, h, f"at {h}", None), hour=h) for h in (8, 9)), newest=None)
    assert "Exchange" in plans[3] and [p.text for p in posts][2:] == ["at "]


def test_a_malformed_payload_leaves_the_landing(spark, run):
    run(20, collected("ann", 7, ANN))
    bad = collected("ann", 7, (3, 21, 1, "three", None))
    bad["TWEET_INFO"]["text"] = 3
    with pytest.raises(Exception, match="(?i)malformed"):
        run(21, bad)
    zone = daily.landing.read_landing(spark, str(run.root), "TWEET_INFO")
    assert [row.post_id for row in zone.collect()] == [1]


def test_packed_payloads_count_for_what_they_unpack_to(spark, tmp_path):
    (tmp_path / "a.json").write_bytes(b"1" * 10)
    (tmp_path / "b.json.gz").write_bytes(b"1" * 10)
    for glob in (tmp_path, f"{tmp_path}/*"):
        assert daily.folders.size_of(spark, str(glob)) == 10 + daily.folders.UNPACKED * 10
