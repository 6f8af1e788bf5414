"""Work that grows with what is new: partial results of marts, missed spend days, landed names, undeclared keys."""

import json
import os
import random

import pytest
from pyspark.sql import functions as F

from callmill import jobs
from callmill.functions.calendar import LANDED_NAME
from callmill.operators.flatten import flatten_documents, leaf_names
from callmill.plans import curated, daily, landing, marts, refresh, spend, states
from callmill.sources import documents, snapshots, tables, versions
from tests.test_pipeline import RECORDS, drop, snapshot, stores  # noqa: F401 - fixtures


def booking(event, day, hour, users=(), event_type="A"):
    payload = {
        "event": event,
        "created_at": f"2024-01-{day:02d}T{hour:02d}:30:00.000000Z",
        "updated_at": f"2024-01-{day:02d}T{hour:02d}:30:00.000000Z",
        "scheduled_event": {
            "event_type": event_type,
            "start_time": f"2024-02-{day:02d}T{hour:02d}:00:00.000000Z",
            "updated_at": f"2024-01-{day:02d}T{hour:02d}:30:00.000000Z",
            "event_memberships": [{"user": u, "user_name": f"Name {u}{day % 3}"} for u in users],
            "invitees_counter": {},
            "location": {},
        },
        "tracking": {},
    }
    return json.dumps({"payload": payload})


def land_day(stores, day, seed):  # noqa: F811
    """Some bookings of a day; every third event was on the day before, too."""
    r = random.Random(seed)
    for i in range(9):
        event = f"e{day - 1 if i % 3 == 0 else day}-{i}"
        text = booking(event, day, r.randrange(24), r.sample("uvwxyz", r.randint(0, 3)), r.choice("ABC"))
        drop(stores, f"2024-01-{day:02d}/{seed}-{i}.json", text)


def land_spend(landed, day, amount):
    folder = os.path.join(landed, f"file_date=2024-01-{day:02d}")
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, f"part-{amount}.txt"), "w") as f:
        f.write("".join(json.dumps({"date": f"2024-01-{day:02d}", "channel": c, "spend": amount + i}) + "\n" for i, c in enumerate(["x", "y"])))


def values(given, names=tuple(marts.MARTS)):
    return {name: sorted(map(tuple, marts.MARTS[name](given).collect()), key=repr) for name in names}


@pytest.fixture
def history(stores, tmp_path):  # noqa: F811
    landed = str(tmp_path / "landed")
    for day in (1, 2, 3):
        land_day(stores, day, day)
        land_spend(landed, day, 10 * day)
    return stores, landed, str(tmp_path / "states")


def test_states_equal_a_full_refresh(spark, history, monkeypatch):
    stores, landed, root = history  # noqa: F811
    channels = curated.channel_map(spark, [("A", "x"), ("B", "y")])
    read = []
    real = versions.read
    monkeypatch.setattr(states.versions, "read", lambda s, p, folders, schema: (read.append({f[0] for f in folders}), real(s, p, folders, schema))[1])

    def check(bookings, spends, names=("channel_leaderboard", "meetings_per_employee_per_day")):
        daily.run_daily(spark, stores)
        read.clear()
        found = states.renew(spark, stores.staging, landed, root)
        assert found.renewed == bookings + spends
        assert read == ([set(bookings)] if bookings else [])
        full = curated.curate(tables.read_staging(spark, stores.staging), channels, tables.read_spends(spark, landed))
        assert values(states.curate(spark, found, channels), names) == values(full, names)

    days = [f"2024-01-0{d}" for d in (1, 2, 3)]
    check(days, days)
    check([], [])
    land_day(stores, 4, 4)  # a new date, with events of the one before
    check(["2024-01-04"], [])
    land_day(stores, 2, 9)  # late documents of an old one
    land_spend(landed, 4, 7)
    check(["2024-01-02"], ["2024-01-04"], marts.MARTS)
    period = ("2024-01-02", "2024-01-03")
    full = curated.curate(tables.read_staging(spark, stores.staging), channels, tables.read_spends(spark, landed), *period)
    some = ["cost_per_lead", "meetings_by_day", "meetings_per_employee_per_day"]
    given = states.curate(spark, states.renew(spark, stores.staging, landed, root), channels, *period)
    assert values(given, some) == values(full, some)


def test_refresh_from_states(spark, history, put):
    stores, landed, root = history  # noqa: F811
    daily.run_daily(spark, stores)
    channels = put("channels.json", '{"event_type":"A","channel_name":"x"}\n{"event_type":"B","channel_name":"y"}\n')
    flags = ["--staging", stores.staging, "--landed", landed, "--channels", channels]
    for name, more in (("full", []), ("quick", ["--states", root])):
        assert jobs.main(["refresh", *flags, "--marts", f"{root}-{name}", *more], spark) == list(marts.MARTS)
    for name in marts.MARTS:
        rows = [list(map(tuple, refresh.read_mart(spark, f"{root}-{side}", name).collect())) for side in ("full", "quick")]
        assert sorted(rows[0], key=repr) == sorted(rows[1], key=repr)


def test_states_without_anything(spark, stores, tmp_path):  # noqa: F811
    found = states.renew(spark, stores.staging, str(tmp_path / "landed"), str(tmp_path / "states"))
    given = states.curate(spark, found, curated.channel_map(spark, [("A", "x")]))
    assert found.renewed == [] and all(mart(given).count() == 0 for mart in marts.MARTS.values())


def day_records(day, amount):
    return [{"date": f"2024-01-{d:02d}", "channel": "A", "spend": amount + d, "file": day} for d in (day - 2, day - 1, day) if d > 0]


def write_days(put, days, amount=100):
    names = [f"spend_data_2024-01-{day:02d}.json" for day in days]
    for day, name in zip(days, names):
        put(f"in/{name}", json.dumps(day_records(day, amount)))
    put("in/index.json", json.dumps({"files": names}))


def landed_rows(spark, path):
    return sorted((str(r.file_date), str(r.date), float(r.spend)) for r in tables.read_spends(spark, path).collect())


def test_a_load_after_missed_days_lands_them_all(spark, put, tmp_path):
    paths = [str(tmp_path / "in"), str(tmp_path / "in/index.json"), str(tmp_path / "landed")]
    write_days(put, [3])
    assert spend.load_latest_spend(spark, *paths).file_date == "2024-01-03"
    # Days 4 to 6 were missed; the file of day 5 was never written, that of day 6 shows it.
    write_days(put, [3, 4, 6], amount=200)
    loads = spend.load_missing_spends(spark, *paths)
    assert [(load.file_date, load.file[-7:-5], load.records) for load in loads] == [
        ("2024-01-02", "04", 1), ("2024-01-04", "06", 1), ("2024-01-05", "06", 1), ("2024-01-06", "06", 1)
    ]
    expected = [("2024-01-02", "2024-01-02", 202.0), ("2024-01-03", "2024-01-03", 103.0)]
    expected += [(f"2024-01-0{d}", f"2024-01-0{d}", 200.0 + d) for d in (4, 5, 6)]
    assert landed_rows(spark, paths[2]) == expected
    assert spend.load_missing_spends(spark, *paths) == []
    # Day 1 was shown by the file of day 3 alone.
    assert [load.file_date for load in spend.load_missing_spends(spark, *paths, everything=True)] == ["2024-01-01"]
    assert spark.read.json(paths[2]).where("file = 6").count() == 3  # fields that nobody knows stay


def test_a_broken_file_lands_nothing(spark, put, tmp_path):
    paths = [str(tmp_path / "in"), str(tmp_path / "in/index.json"), str(tmp_path / "landed")]
    write_days(put, [3, 4])
    put("in/spend_data_2024-01-04.json", "[1]")
    with pytest.raises(snapshots.BrokenSnapshot, match="2024-01-04.json: record_not_object"):
        spend.load_missing_spends(spark, *paths)
    assert not os.path.exists(paths[2])
    put("in/index.json", '{"files": []}')
    assert spend.load_missing_spends(spark, *paths) == []


def test_a_refused_row_can_be_traced_to_its_landed_name(spark, stores):  # noqa: F811
    """Accepted by the intake, refused by the daily job: the tracking part is null."""
    sound, refused = json.loads(booking("e1", 1, 1)), json.loads(booking("e2", 1, 1))
    refused["payload"]["tracking"] = None
    texts = [json.dumps(sound), json.dumps(refused, indent=1)]
    landing.intake(spark.createDataFrame([(t,) for t in texts], "body string"), ["A"], stores.raw)
    lines = [row.value for row in spark.read.text(stores.raw).collect()]
    names = {line.split("\t")[0]: json.loads(line.split("\t", 1)[1])["payload"]["event"] for line in lines}
    assert len(names) == 2
    drop(stores, "2024-01-01/plain.txt", "2024 no name\tbad")  # a line that did not come by the intake
    daily.run_daily(spark, stores, documents.LINES)
    found = {row.landed: row for row in daily.read_quarantine(spark, stores).collect()}
    [traced] = [name for name, event in names.items() if event == "e2"]
    assert set(found) == {traced, None}
    assert found[traced].reason == "tracking_not_object" and json.loads(found[traced].body) == refused
    assert found[None].body == "2024 no name\tbad"
    assert spark.createDataFrame([(traced,)], "name string").where(F.col("name").rlike(LANDED_NAME)).count() == 1
    assert [row.event for row in tables.read_staging(spark, stores.staging).collect()] == ["e1"]


def plain_leaves(value, parent=""):
    found = {}
    for key, inner in value.items():
        name = f"{parent}_{key}" if parent else key
        for leaf, v in (plain_leaves(inner, name) if isinstance(inner, dict) else {name: inner}).items():
            found.pop(leaf, None)  # the last one counts
            found[leaf] = v
    return found


def some_object(r, depth=0):
    keys = ["a", "b", "a_b", "b_a", "a_b_a", "é", "", "x.y", "x'y", 'q"t', "null"]
    leaf = lambda: r.choice([None, True, 3, -2.5, "t", "", "{}", [], [1, {"a": {"b": 2}}], {}])
    return {
        k: some_object(r, depth + 1) if depth < 4 and r.random() < 0.45 else leaf()
        for k in r.sample(keys, r.randint(0, 5))
    }


def test_leaves_of_undeclared_keys(spark):
    r = random.Random(2)
    given = [some_object(r) for _ in range(200)] + [{}, {"deep": {"er": {"and": {"deep": {"er": {"still": 1}}}}}}]
    texts = [json.dumps(d, ensure_ascii=i % 2 == 0, indent=i % 3 or None) for i, d in enumerate(given)]
    texts += ["not json", "[1]", '"text"', None, '{"a":{"b":1},"a":{"c":2}}', '{"a_b":1,"a":{"b":2},"c":{"d":1},"c_d":5,"a_b":7}']
    expected = {i: plain_leaves(d) for i, d in enumerate(given)}
    n = len(given)
    expected |= {n + 4: {"a_c": 2}, n + 5: {"a_b": 2, "c_d": 5}}
    rows = spark.createDataFrame(list(enumerate(texts)), "id int, body string").repartition(3)
    found = {}
    for row in flatten_documents(rows).collect():
        found.setdefault(row.id, {})[row.leaf] = json.loads(row.value)
    assert found == {i: leaves for i, leaves in expected.items() if leaves}
    names = leaf_names(flatten_documents(rows.where(f"id = {n - 1}"))).collect()
    assert [tuple(row) for row in names] == [("deep_er_and_deep_er_still", 1)]


def test_leaves_are_found_without_a_shuffle_or_a_turn_for_each_level(spark):
    deep = 1
    for i in range(40):
        deep = {f"k{i}": deep, "x": i}
    # Like names in order: of many objects of one, and behind repeated keys.
    wide = {f"o{i}": {"a": i} for i in range(150)} | {"o7_a": "last"}
    twice = '{"p_q":0,"p":{"q":1,"r_s":2,"r":{"s":3},"r_s":4},"p_q":5}'
    # Doubles below the first level, where a text is read anew; the value as it is given above.
    numbers = '{"n":1e5,"m":{"n":1e5,"l":[0.12345678901234567890],"t":"1.5"}}'
    texts = [json.dumps(deep), json.dumps(wide), twice, numbers]
    rows = spark.createDataFrame(list(enumerate(texts)), "id int, body string")
    sc = spark.sparkContext
    sc.setJobGroup("leaves", "leaves")
    try:
        leaves = flatten_documents(rows)
        found = {}
        for row in leaves.collect():
            found.setdefault(row.id, {})[row.leaf] = row.value
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    assert len(sc.statusTracker().getJobIdsForGroup("leaves")) < 8
    assert "Exchange" not in leaves._jdf.queryExecution().executedPlan().toString()
    assert {k: json.loads(v) for k, v in found[0].items()} == plain_leaves(deep) and len(found[0]) == 41
    assert {k: json.loads(v) for k, v in found[1].items()} == plain_leaves(wide)
    assert found[2] == {"p_q": "1", "p_r_s": "3"}
    assert found[3] == {"n": "100000.0", "m_n": "100000", "m_l": "[0.12345678901234568]", "m_t": '"1.5"'}
