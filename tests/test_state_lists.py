"""List state as text: whole, in the order of its places, and its latest
entries, beside value, map and reducing state."""

import datetime as dt

import __spark_entry__ as entry
from eventide.streaming.carry import list_texts

T0 = dt.datetime(2024, 1, 1)


def test_list_texts(spark):
    rows = [(u, p, t) for u, x in {1: "abcde", 2: "z", None: "xy"}.items() for p, t in enumerate(x, 1)]
    rows += [(3, 1, "a"), (3, 2, None), (3, 3, "c"), (3, 4, "d"), (4, 1, None)]
    got = list_texts(spark.createDataFrame(rows[::-1], "u int, pos long, item string").repartition(4), "u", 3)
    assert {r.u: (r.whole, r["last"]) for r in got.collect()} == {
        1: ("a,b,c,d,e", "c,d,e"), 2: ("z", "z"), None: ("x,y", "x,y"), 3: ("a,c,d", "c,d"), 4: (None, None),
    }


def test_state_kinds_has_the_list(spark, tmp_path):
    kinds = ["view", "signup", "click", "view", "error", "view", "click"]
    rows = [(i, T0 + dt.timedelta(hours=i), u, k, float(i), "") for u in (7, 8) for i, k in enumerate(kinds[: 7 if u == 7 else 2])]
    schema = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{tmp_path}/events.parquet")
    got = {r.user_id: (r.n, r.last_types, r.types, r.type_counts) for r in entry.queries()["stream_state_kinds"](spark, str(tmp_path)).collect()}
    assert got == {
        7: (6, "error,view,click", "signup,click,view,error,view,click", "click:2,error:1,signup:1,view:2"),
        8: (1, "signup", "signup", "signup:1"),
    }
