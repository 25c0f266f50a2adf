import random
from collections import defaultdict
from datetime import date, timedelta

from tidemark.llm.url_filter import judge, validity


def day(n):
    return date(2023, 1, 1) + timedelta(n)


def brute(captures, entries):
    changes = defaultdict(list)
    for name, key, action, on in entries:
        if None not in (name, key, on) and action in ("add", "remove"):
            changes[name, key].append((on, action != "remove"))
    out = []
    for i, url, when in captures:
        held = set()
        if url is not None and when is not None:
            bare = url.strip().lower().split("://", 1)[-1]
            bare = bare.split("?")[0].split("#")[0]
            host, _, path = bare.partition("/")
            host = host.rsplit("@", 1)[-1].split(":")[0]
            host = host.removeprefix("www.")
            labels = host.split(".")
            keys = {"d:" + ".".join(labels[k:]) for k in range(max(1, len(labels) - 1))}
            parts = [p for p in path.split("/") if p]
            keys |= {"p:" + host + "/" + "/".join(parts[:k]) for k in range(1, len(parts) + 1)}
            for (name, key), c in changes.items():
                past = [(on, a) for on, a in c if on <= when]
                if host and key in keys and past:
                    last = max(on for on, _ in past)
                    if all(a for on, a in past if on == last):
                        held.add(name)
        out.append((i, sorted(held)))
    return out


def test_against_brute_force(spark):
    r = random.Random(6)
    hosts = ["a.org", "x.a.org", "b.co", "www.b.co", "c.d.e.net"]
    keys = ["d:a.org", "d:x.a.org", "d:b.co", "p:b.co/q", "p:a.org/q/r", "d:e.net", "d:net", "p:a.org/q/r/s/t"]
    entries = [(r.choice(["l1", "l2"]), r.choice(keys), r.choice(["add", "add", "remove"]), day(r.randint(0, 400))) for _ in range(60)] + [(None, "d:a.org", "add", day(1)), ("l3", None, "add", day(1)), ("l3", "d:a.org", "add", None), ("l3", "d:a.org", "odd", day(1))]
    paths = ["", "/", "/q", "/q/r?z=1", "/q//r/s/t", "#f", "/Q/R"]
    captures = [(i, r.choice(["http://", "https://", "HTTPS://u@"]) + r.choice(hosts) + r.choice(["", ":80"]) + r.choice(paths), day(r.randint(-20, 450))) for i in range(200)]
    captures += [(900, None, day(3)), (901, "http://a.org", None), (902, "", day(5)), (903, "junk", day(5)), (0, captures[0][1], captures[0][2])]
    c = spark.createDataFrame([(u, i, w, "old") for i, u, w in captures], "url string, page_id long, fetched date, lists string").repartition(3)
    e = spark.createDataFrame(entries, "list string, key string, action string, on date")
    got = sorted((x.page_id, x.lists) for x in judge(c, e).collect())
    assert got == sorted(brute(captures, entries))
    assert all(x.blocked == bool(x.lists) for x in judge(c, e).collect())


def test_validity_and_empty(spark):
    e = spark.createDataFrame([("l", "k", "add", day(1)), ("l", "k", "add", day(4)), ("l", "k", "remove", day(9)), ("l", "k", "add", day(9)), ("l", "k", "add", day(12))], "list string, key string, action string, on date")
    assert sorted((r.since, r.until) for r in validity(e).collect()) == [(day(1), day(9)), (day(12), date(9999, 12, 31))]
    none = spark.createDataFrame([], "page_id long, url string, fetched date")
    assert judge(none, e).collect() == []
    some = spark.createDataFrame([(1, "http://a", day(1))], "page_id long, url string, fetched date")
    assert judge(some, e.filter("list = 'z'")).first().lists == []


def test_entries_of_any_depth_block(spark):
    deep = "/".join(f"s{k}" for k in range(1, 41))
    keys = ["p:a.org/q/r/s/t", f"p:b.co/{deep}", "p:c.net/1/2/3/4/5"]
    e = spark.createDataFrame([(f"l{i}", k, "add", day(1)) for i, k in enumerate(keys)], "list string, key string, action string, on date")
    urls = ["http://a.org/q//r/s/t", "http://a.org/Q/r/s/t/u?x=1", "http://a.org/q/r/s", f"https://www.b.co/{deep}/x", f"https://b.co/{deep[:-1]}", "http://c.net/1/2/3/4/5", "http://c.net/1/2/3/4/6", "http://c.net"]
    c = spark.createDataFrame([(i, u, day(5)) for i, u in enumerate(urls)], "page_id long, url string, fetched date")
    got = {x.page_id: x.lists for x in judge(c, e).collect()}
    assert got == {0: ["l0"], 1: ["l0"], 2: [], 3: ["l1"], 4: [], 5: ["l2"], 6: [], 7: []}
    assert all(x.lists == [] for x in judge(c, e.filter("key = 'p:none'")).collect())
