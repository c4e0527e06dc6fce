import datetime as dt
import glob
import json
import os

import pytest
from pyspark.sql import functions as F

from socialtext.operators import reshape
from socialtext.operators.filters import export_filter
from socialtext.operators.language import fit_profiles
from socialtext.plans.geo_filter import geo_posts, run_days
from socialtext.plans.ingest import ingest_batch, stored
from socialtext.plans.store import KeyedStore
from socialtext.plans.tokenize_daily import map_partitions, tokenize_days
from socialtext.schemas import post_schema
from socialtext.sources import categories, incremental, readers, writers
from socialtext.streaming.intake import post_stream, start_intake, window_counts, without_repeats
from tests.posts import PLACE, POINT, post, user, write_array, write_lines, write_nested

LONG = {"full_text": "the long text"}


def sample():
    inner = post(1, 7, extended_tweet=LONG)
    quoted = post(2, 8)
    return [
        post(10, 1, retweeted_status=inner),
        post(11, 2, quoted_status=quoted, coordinates=POINT),
        post(12, 3, retweeted_status=post(3, 9, quoted_status=post(4, 10)), place=PLACE),
        {"limit": {"track": 5}},
        post(13, 4, extended_tweet=LONG, in_reply_to_status_id=99),
        post(10, 1, text="a later copy"),
    ]


@pytest.fixture
def dump(tmp_path):
    path = str(tmp_path / "raw" / "streamed_02_04_2020_10_00_00.json.gz")
    write_nested(path, sample()[:3], sample()[3:])
    return str(tmp_path / "raw")


def test_nested_reader(spark, dump):
    rows = readers.read_nested_json(spark, dump).select("id", "position").collect()
    assert [r["id"] for r in rows] == [10, 11, 12, None, 13, 10]
    assert readers.read_nested_json(spark, dump, partitions=2).count() == 6


def test_other_containers(spark, tmp_path):
    write_array(str(tmp_path / "d" / "a.json.gz"), sample())
    write_lines(str(tmp_path / "e" / "a.json"), sample())
    assert readers.read_day(spark, str(tmp_path / "d")).count() == 6
    assert readers.read_posts(spark, str(tmp_path / "e")).count() == 6
    with pytest.raises(ValueError):
        readers.read_posts(spark, "x", categories="y")
    catalog = categories.with_category(categories.list_files(spark, str(tmp_path)), cat_pattern="/[de]/")
    assert readers.read_posts(spark, categories="/d", catalog=catalog).count() == 6


def test_explode_and_rows(spark, dump):
    posts = reshape.explode_embedded(readers.read_nested_json(spark, dump)).cache()
    ids = [r["id"] for r in posts.orderBy("position", "level_order").collect()]
    assert sorted(ids) == [1, 2, 3, 4, 10, 10, 11, 12, 13]
    rows = {(r["id"], r["position"]): r for r in reshape.post_rows(posts).collect()}
    by_id = {k[0]: r for k, r in rows.items() if k[1] != 2 or k[0] != 10}
    assert by_id[12]["retweet_id"] == 3 and by_id[12]["full_text"] == "text 3"
    assert by_id[11]["quote_id"] == 2 and by_id[11]["retweet_id"] is None
    assert by_id[13]["full_text"] == "the long text" and by_id[13]["reply_id"] == 99
    assert by_id[1]["full_text"] == "the long text" and by_id[3]["quote_id"] == 4
    reposts = [r for r in reshape.post_rows(posts).collect() if r["id"] == 10 and r["retweet_id"] == 1]
    assert reposts[0]["full_text"] == "the long text"
    assert by_id[13]["created"] == dt.datetime(2020, 4, 2, 10)
    users = reshape.user_rows(posts).collect()
    assert {u["user_id"] for u in users} == {1, 2, 3, 4, 7, 8, 9, 10} and all(u["located"] is None for u in users)
    assert [r["tweet_id"] for r in reshape.geo_rows(posts).collect()] == [11]
    assert [r["tweet_id"] for r in reshape.place_rows(posts).collect()] == [12]
    assert '"text":"x"' in reshape.entity_rows(posts).first()["entities"]


def test_ingest_is_idempotent(spark, dump, tmp_path):
    store = str(tmp_path / "store")
    posts = readers.read_nested_json(spark, dump)
    for _ in range(2):
        ingest_batch(posts, store, ("users", "tweet", "entity", "geo", "place"))
    tweets = stored(spark, f"{store}/tweet")
    assert sorted(r["id"] for r in tweets.collect()) == [1, 2, 3, 4, 10, 11, 12, 13]
    assert tweets.filter("id = 10").first()["full_text"] == "the long text"  # the first copy stays
    assert stored(spark, f"{store}/users").count() == 8
    assert stored(spark, f"{store}/geo").count() == 1 and stored(spark, f"{store}/place").count() == 1


EXTRA = {"lang": "en", "source": "<a href='x'>app</a>", "possibly_sensitive": False, "deep": {"list": [1, {"x": None}, "ü"]}}


def test_whole_records_pass_through(spark, tmp_path):
    """Fields that no schema declares come through reader, geo job, writer and payload tables, in batch and as a stream."""
    entities = {"hashtags": [{"text": "x", "indices": [0, 2]}], "symbols": [{"text": "q"}]}
    posts = [post(100 + i, 50 + i, geo=POINT, **EXTRA) for i in range(30)]
    posts += [post(200, 90, geo=POINT, retweeted_status=post(1, 5, entities=entities, **EXTRA), place={**PLACE, "bounding_box": {"type": "Polygon"}}, entities=None)]
    write_lines(str(tmp_path / "in" / "2020_04_02" / "a.json"), posts[:20])
    write_array(str(tmp_path / "in" / "2020_04_02" / "b.json.gz"), posts[20:])
    run_days(spark, str(tmp_path / "in"), str(tmp_path / "out"), filter_users=False)
    got = {}
    for r in spark.read.text(str(tmp_path / "out" / "2020_04_02")).collect():
        one = json.loads(r["value"])
        got[one["id"]] = one
    assert got == {p["id"]: p for p in posts}
    whole = readers.read_posts(spark, str(tmp_path / "in" / "2020_04_02"), whole=True)
    assert whole.count() == 31 and whole.where("id = 200").first()["place"]["full_name"] == "Here"

    raw = str(tmp_path / "raw")
    write_nested(f"{raw}/streamed_02_04_2020_10_00_00.json.gz", posts[:3], posts[3:])
    tables = ("users", "tweet", "entity", "geo", "place")
    ingest_batch(readers.read_nested_json(spark, raw, whole=True), str(tmp_path / "batch"), tables)
    start_intake(post_stream(spark, raw, whole=True), str(tmp_path / "stream"), str(tmp_path / "ledger"), tables=tables).awaitTermination()
    for store in ("batch", "stream"):
        for _ in range(2):
            payload = {r["tweet_id"]: r["entities"] for r in stored(spark, str(tmp_path / store / "entity")).collect()}
            assert json.loads(payload[1]) == entities and payload[200] is None and len(payload) == 32
            assert json.loads(stored(spark, str(tmp_path / store / "place")).first()["places"])["bounding_box"] == {"type": "Polygon"}
            ingest_batch(readers.read_nested_json(spark, raw, whole=True), str(tmp_path / store), tables)


def test_language_at_intake(spark, tmp_path):
    words = {"en": "the house and the garden of the old man", "de": "der Garten und das Haus von dem alten Mann"}
    posts = [post(10 + i, i, text=words["en" if i % 2 else "de"] + f" {i}") for i in range(6)] + [post(20, 1, text="12345")]
    profiles = fit_profiles(spark.createDataFrame(list(words.items()), "lang string, text string"), "text", "lang")
    profiles.write.parquet(str(tmp_path / "profiles"))
    raw = str(tmp_path / "raw")
    write_nested(f"{raw}/streamed_02_04_2020_10_00_00.json.gz", posts)
    ingest_batch(readers.read_nested_json(spark, raw), str(tmp_path / "batch"), profiles=profiles)
    start_intake(post_stream(spark, raw), str(tmp_path / "stream"), str(tmp_path / "ledger"), profiles=str(tmp_path / "profiles")).awaitTermination()
    for store in ("batch", "stream"):
        tweets = stored(spark, str(tmp_path / store / "tweet"))
        assert {r["id"]: r["language"] for r in tweets.collect()} == {**{10 + i: "en" if i % 2 else "de" for i in range(6)}, 20: "00"}
        english = export_filter(tweets, dt.datetime(2020, 1, 1), dt.datetime(2021, 1, 1), "en")
        assert sorted(r["id"] for r in english.collect()) == [11, 13, 15]


@pytest.mark.parametrize("whole", [False, True])
def test_first_of_json_lines_stays(spark, tmp_path, whole):
    lines = [post(i % 5, 1, text=f"copy {i}") for i in range(1, 60)]
    write_lines(str(tmp_path / "in" / "a.json"), lines)
    write_lines(str(tmp_path / "in" / "b.json"), lines[::-1])
    posts = readers.read_posts(spark, str(tmp_path / "in"), with_position=True, whole=whole).repartition(4)
    ingest_batch(posts, str(tmp_path / "store"), ("tweet",))
    assert {r["id"]: r["full_text"] for r in stored(spark, str(tmp_path / "store" / "tweet")).collect()} == {i: f"copy {i or 5}" for i in range(5)}
    start_intake(post_stream(spark, str(tmp_path / "in"), nested=False), str(tmp_path / "s"), str(tmp_path / "ledger"), tables=("tweet",)).awaitTermination()
    assert stored(spark, str(tmp_path / "s" / "tweet")).count() == 5


def test_store_reads_only_the_buckets_of_the_batch(spark, tmp_path):
    store = KeyedStore(str(tmp_path / "t"), "id", span=100)
    rows = spark.range(1000).select("id", F.lit(1).alias("version"), F.concat(F.lit("old"), "id").alias("text"))
    store.append(store.new_rows(rows, [F.col("id")]))
    batch = spark.createDataFrame([(250, 2, "new"), (250, 1, "older"), (251, 0, "late"), (1207, 1, "first"), (None, 9, "lost")], "id long, version int, text string")
    new = store.new_rows(batch, [F.col("version")])
    plan = new._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "key_bucket" in plan.split("PartitionFilters", 1)[1][:200] and "IN (2,12)" in plan
    assert [r["id"] for r in new.collect()] == [1207]
    before = {f: os.path.getmtime(f) for f in glob.glob(str(tmp_path / "t" / "*" / "*.parquet"))}
    store.replace_newest(batch, "version")
    after = {f: os.path.getmtime(f) for f in glob.glob(str(tmp_path / "t" / "*" / "*.parquet"))}
    assert {f for f in before if before[f] == after.get(f)} == {f for f in before if "key_bucket=2/" not in f}
    got = {r["id"]: (r["version"], r["text"]) for r in store.read(spark).collect()}
    assert len(got) == 1001 and got[250] == (2, "new") and got[251] == (1, "old251") and got[1207] == (1, "first") and got[249] == (1, "old249")
    store.replace_newest(batch, "version")
    assert store.read(spark).count() == 1001


def test_stream_equals_batch(spark, tmp_path):
    raw, store = str(tmp_path / "in"), str(tmp_path / "store")
    write_nested(f"{raw}/streamed_02_04_2020_10_00_00.json.gz", sample()[:3])
    checkpoint = str(tmp_path / "ledger")
    start_intake(post_stream(spark, raw, max_files=1), store, checkpoint).awaitTermination()
    write_nested(f"{raw}/streamed_02_04_2020_11_00_00.json.gz", sample())
    start_intake(post_stream(spark, raw, max_files=1), store, checkpoint).awaitTermination()
    batch = str(tmp_path / "batch")
    ingest_batch(readers.read_nested_json(spark, raw), batch)
    for name in ("users", "tweet", "geo"):
        a, b = stored(spark, f"{store}/{name}"), stored(spark, f"{batch}/{name}")
        assert a.count() == b.count() and a.drop("file_time").exceptAll(b).count() == 0


def test_stream_windows(spark, tmp_path):
    rows = spark.range(6).select("id", (F.col("id") * 43200 + 1577836800).cast("timestamp").alias("t"))
    rows.union(rows).write.parquet(str(tmp_path / "s"))
    stream = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "s"))
    for frame, name, mode in ((window_counts(stream, "t"), "w", "complete"), (without_repeats(stream, "t"), "d", "append")):
        frame.writeStream.format("memory").queryName(name).outputMode(mode).trigger(availableNow=True).start().awaitTermination()
    assert [r["n"] for r in spark.table("w").orderBy("start").collect()] == [4, 4, 4]
    assert spark.table("d").count() == 6


def test_geo_day(spark, tmp_path):
    original = post(1, 5)
    posts = [post(100 + i, 50 + i, retweeted_status={**original, "place": PLACE}) for i in range(10)]
    posts += [post(200 + i, 80 + i, geo=POINT) for i in range(40)]
    posts += [post(300, 2, coordinates=POINT, user=user(2, followers=10 ** 9)), post(301, 3, geo=POINT, user=user(3, followers=0)),
              post(302, 4), post(303, 6, quoted_status={**post(5), "coordinates": POINT}), {"limit": {}}]
    write_lines(str(tmp_path / "in" / "2020_04_02" / "a.json"), posts)
    write_lines(str(tmp_path / "in" / "2020_04_03" / "a.json"), posts)
    df = readers.read_day(spark, str(tmp_path / "in" / "2020_04_02"))
    kept = sorted(r["id"] for r in geo_posts(df).collect())
    # ceil(sqrt(10)) = 4 reposts by id; the outlier, the zero counter and the post without a place go.
    assert kept == [100, 101, 102, 103] + [200 + i for i in range(40)] + [303]
    assert sorted(r["id"] for r in geo_posts(df, unique_ids=True).collect()) == kept
    assert sorted(r["id"] for r in geo_posts(df, hot_rows=3, salts=3).collect()) == kept
    assert geo_posts(df, filter_reposts=False, filter_users=False).count() == 10 + 40 + 3
    log = run_days(spark, str(tmp_path / "in"), str(tmp_path / "out")).orderBy("day").collect()
    assert [(r["day"], r["status"], r["n"], r["total"]) for r in log] == [
        ("2020_04_02", "done", 45, 45), ("2020_04_03", "done", 45, 90)]
    assert run_days(spark, str(tmp_path / "in"), str(tmp_path / "out")).count() == 0


def test_failed_day_is_logged(spark, tmp_path, monkeypatch):
    from socialtext.plans import geo_filter
    write_lines(str(tmp_path / "in" / "2020_04_02" / "a.json"), [post(1, geo=POINT)])
    monkeypatch.setattr(geo_filter, "read_day", lambda *a, **k: 1 / 0)
    row = run_days(spark, str(tmp_path / "in"), str(tmp_path / "out")).first()
    assert row["status"] == "failed" and "division" in row["message"]


def test_files(spark, tmp_path):
    names = ["streamed_02_04_2020_10_00_00.json.gz", "streamed_01_04_2020_23_59_59.json.gz", "notes.txt"]
    for n in names:
        (tmp_path / n).write_text("x")
    files = categories.with_file_time(categories.list_files(spark, str(tmp_path)))
    assert [r["name"] for r in categories.order_files(files).collect()] == [names[1], names[0]]
    assert [r["name"] for r in categories.order_files(files, descending=True).collect()] == names[:2]
    assert [r["name"] for r in categories.order_files(files, days="even").collect()] == [names[0]]
    assert categories.name_matches(files, categories.STREAM_NAME).count() == 2


def test_categories(spark, tmp_path):
    files = spark.createDataFrame([("a/2020-01-01/x",), ("a/2020-01-02/y",)], "path string")
    cats = categories.with_category(files, cat_pattern=r"[0-9]{4}-[0-9]{2}-[0-9]{2}")
    assert [r[0] for r in categories.categories_of(cats).collect()] == ["2020-01-01", "2020-01-02"]
    assert [r[0] for r in categories.files_of(cats, "2020-01-02").collect()] == ["a/2020-01-02/y"]
    assert categories.files_of(cats, ["2020-01-01", "2020-01-02"]).count() == 2
    for bad in ("1999", ["1999"]):
        with pytest.raises(ValueError):
            categories.files_of(cats, bad)
    mapped = categories.with_category(files, cat_map={"a/2020-01-01/x": ["news", "all"]})
    assert sorted(r["category"] for r in mapped.collect()) == ["all", "news"]
    (tmp_path / "cats.txt").write_text("a/2020-01-01/x news all\na/2020-01-02/y all\n")
    by_file = categories.with_category(files, cat_file=str(tmp_path / "cats.txt"))
    assert by_file.filter("category = 'all'").count() == 2
    (tmp_path / "bad.txt").write_text("nowhere news\n")
    with pytest.raises(ValueError):
        categories.with_category(files, cat_file=str(tmp_path / "bad.txt"))
    with pytest.raises(ValueError):
        categories.with_category(files)
    assert categories.union_catalogs(files, files).count() == 2


def test_tables_on_disk(spark, tmp_path):
    rows = spark.createDataFrame(
        [(1, 9, dt.datetime(2020, 4, 1, 5), 'two\nlines "quoted"', "en", None), (2, 9, dt.datetime(2020, 4, 2, 5), "b", "en", 7),
         (3, 9, dt.datetime(2020, 5, 2, 5), "#bigcity Covid-19", "en", None)],
        "id long, user_id long, created timestamp, full_text string, language string, retweet_id long")
    csv = str(tmp_path / "csv")
    writers.write_export_csv(rows, csv, dt.datetime(2020, 3, 10), dt.datetime(2020, 4, 14))
    back = readers.read_export_csv(spark, csv).collect()
    assert [(r["id"], r["full_text"]) for r in back] == [(1, 'two\nlines "quoted"')]
    day = str(tmp_path / "days")
    writers.write_by_date(rows, day)
    picked = readers.read_tokens(spark, day, [[("tw_year", "=", 2020), ("tw_month", "=", 4), ("tw_day", "=", 2)],
                                              [("tw_year", "=", 2020), ("tw_month", "=", 5)]], ["id"])
    assert sorted(r[0] for r in picked.collect()) == [2, 3]
    assert "PartitionFilters: []" not in picked._jdf.queryExecution().executedPlan().toString()
    tokens = str(tmp_path / "tokens")
    words = spark.createDataFrame([("big", 0), ("city", 1)], "word string, rank int")
    lemmas = spark.createDataFrame([("lines", "line")], "form string, lemma string")
    tokenize_days(spark, day, tokens, words=words, lemmas=lemmas)
    got = {r["id"]: r["tokens"] for r in spark.read.parquet(tokens).collect()}
    assert got[3] == ["big", "city", "coronavirus"] and got[1] == ["line", "quoted"]
    writers.append_by_month(rows, str(tmp_path / "m"), "created")
    writers.append_by_month(rows, str(tmp_path / "m"), "created")
    assert readers.month_range(spark.read.parquet(str(tmp_path / "m")), "2020_04", "2020_04").count() == 4
    writers.write_daily_json(rows, str(tmp_path / "j"), "created")
    assert (tmp_path / "j" / "day=2020_04_01").exists()


def test_ranges(spark):
    df = spark.createDataFrame([(dt.datetime(2020, 1, d), "en" if d % 2 else "fr") for d in range(1, 6)],
                               "created timestamp, language string")
    a, b = dt.datetime(2020, 1, 2), dt.datetime(2020, 1, 4)
    assert readers.in_range(df, a, b).count() == 3
    assert readers.in_range(df, a).count() == 4 and readers.in_range(df, languages=["fr"]).count() == 2
    assert [r[0].day for r in readers.in_range(df.orderBy(F.desc("created")), ordered=True).select("created").collect()] == [1, 2, 3, 4, 5]
    with pytest.raises(TypeError):
        readers.in_range(df, "2020")
    with pytest.raises(TypeError):
        readers.in_range(df, languages="en")


def test_incremental(spark):
    days = lambda *xs: spark.createDataFrame([(x,) for x in xs], "folder string")
    assert [r[0] for r in incremental.days_to_do(days("2020_01_02", "2020_01_01", "tmp"), days("2020_01_01")).collect()] == ["2020_01_02"]
    people = spark.createDataFrame([("a",), (None,), ("b",)], "handle string")
    done = spark.createDataFrame([("a",)], "screen_name string")
    assert [r[0] for r in incremental.keys_to_do(people, done, "handle", "screen_name").collect()] == ["b"]


def test_hooks(spark):
    out = map_partitions(spark.range(3), lambda frames: (f.assign(id=f.id * 2) for f in frames), "id long")
    assert sorted(r[0] for r in out.collect()) == [0, 2, 4]
    posts = spark.createDataFrame([], post_schema())
    assert "screen_name" in reshape.timeline_rows(posts, F.lit("me"), user_id=F.lit(5)).columns
