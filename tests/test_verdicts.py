"""Statuses, demand, names, notes, lookups: the cases that their rules tell apart."""

import datetime

from pyspark.sql import functions as F

from millrace.operators import verdicts


def test_catalogue_reasons_keep_their_order(spark):
    rows = [("ok", 5, 1, 1, 0, 0, 0, 9, True), ("part", 2, 0, 1, 0, 0, 1, 9, True), ("none", 0, 0, 0, 0, 0, 0, 0, True), ("cand", 0, 0, 0, 0, 0, 0, 4, False), ("wait", 0, 3, None, 0, 0, 0, 4, None)]
    frame = spark.createDataFrame(rows, "id string, r int, awaiting int, not_recommended int, outside_launch int, share_alike_only int, licence_review int, cand int, job boolean")
    status, reasons = verdicts.catalogue_status(F.col("r"), 5, {k: F.col(k) for k, _ in verdicts.EVIDENCE}, F.col("cand"), F.col("job"))
    assert {r.id: (r.s, r.why) for r in frame.select("id", status.alias("s"), reasons.alias("why")).collect()} == {
        "ok": ("ok", ["full_evaluation"]), "part": ("partial", ["fewer_than_minimum", "evaluated_not_recommended", "licence_review"]), "none": ("none_yet", ["no_relationship_evidence"]),
        "cand": ("none_yet", ["no_job_definition", "corpus_candidates_only"]), "wait": ("none_yet", ["awaiting_full_evaluation", "no_job_definition"]),
    }


def test_a_link_is_found_by_name_and_number(spark):
    links = spark.createDataFrame([("h/a/x",), ("h/b/y",), ("h/c/z",), ("h/d/w",), ("h/e/v",), ("h/f/u",)], "link string")
    lookups = spark.createDataFrame([("h/b/y", True, "B/New", 7, 200), ("h/c/z", True, "c/z", 9, 200), ("h/d/w", False, None, None, 404), ("h/e/v", True, "e/Moved", None, 200)], "link string, found boolean, name string, number long, answer int")
    corpus = spark.createDataFrame([("h/a/x", "h", 1, "A", True), ("h/b/new", "h", None, "B", False)], "name string, host string, number long, id string, canonical boolean")
    pool = spark.createDataFrame([("h/q/q", "h", 9, "P")], "name string, host string, number long, id string")
    got = {r.link: (r.key, r.status) for r in verdicts.resolved(links, lookups, corpus, pool).collect()}
    assert got == {"h/a/x": ("A", "canonical"), "h/b/y": ("B", "corpus"), "h/c/z": ("P", "candidate"), "h/d/w": ("h/d/w", "not_found"), "h/e/v": ("h/e/moved", "unresolved"), "h/f/u": ("h/f/u", "unresolved")}


def test_demand_is_of_the_longest_single_name(spark):
    names = spark.createDataFrame([("search", "Google Search"), ("docs", "Google Docs"), ("g", "google"), ("n1", "Notes"), ("n2", "notes"), ("x", "ab")], "id string, name string")
    keywords = [("google docs alternative", 10), ("Google-Docs  (2024) alternative", 15), ("best google alternative", 5), ("notes alternative", 99), ("google docs", 50), ("ab alternative", 7), ("googledocs alternative", 7), ("google search alternative free", -1), (None, 3), ("alternative google docs", None)]
    got = {r.id: (r.volume, r.n_keywords) for r in verdicts.demand(spark.createDataFrame(keywords, "keyword string, volume long"), names, ["alternative"]).collect()}
    assert got == {"docs": (15, 1), "g": (5, 1)}
    total = verdicts.total_demand(spark.createDataFrame([("a", 2), ("a", 3)], "id string, volume long"), spark.createDataFrame([("b",)], "id string"), spark.createDataFrame([("a",), ("b",), ("c",)], "id string"))
    assert {r.id: r.volume for r in total.collect()} == {"a": 5, "b": 0, "c": None}


def test_names_and_notes(spark):
    names = spark.createDataFrame([("h/own/the-tool", 2, "The Tool"), ("h/own/the-tool", 1, "Tool stack (A + B)"), ("h/own/x", 1, "Y (self-host)"), ("h/own/x", 2, "Plain"), ("h/own/z", 1, "a/b"), ("h/Own/w", 3, "own"), ("h/Own/w", 1, "W2")], "id string, priority int, name string")
    assert {r.id: r.name for r in verdicts.display_names(names).collect()} == {"h/own/the-tool": "The Tool", "h/own/x": "Plain", "h/own/z": "a/b", "h/Own/w": "own"}
    frame = spark.createDataFrame([(1, 90.0, 80.0, 70.0, 10.0), (2, None, 50.0, 55.0, 59.0), (3, 10.0, 20.0, None, 5.0)], "id int, a double, b double, c double, d double")
    top, low, said = verdicts.note([(k, k.upper(), F.col(k)) for k in "abcd"], 60, 40)
    got = {r.id: (r.top, r.low, r.said) for r in frame.select("id", top.alias("top"), low.alias("low"), said.alias("said")).collect()}
    assert got == {1: (["A", "B"], ["D"], "Strongest on A and B; weakest on D."), 2: ([], [], None), 3: ([], ["D", "A"], "Weakest on D and A.")}


def test_lookups_and_violations(spark):
    day = lambda n: datetime.datetime(2024, 1, n)
    rows = spark.createDataFrame([("a", 1.0), ("b", 5.0), ("b", 9.0), ("c", 3.0), ("d", 2.0)], "key string, strength double")
    readings = spark.createDataFrame([("a", day(9)), ("b", day(1)), ("b", day(2)), ("d", day(1))], "key string, observed_at timestamp")
    got = {r.key: r.state for r in verdicts.due(rows, readings, F.lit("2024-01-10").cast("timestamp"), 2, 2).collect()}
    assert got == {"a": "fresh", "b": "asked", "c": "asked", "d": "deferred"}
    answers = spark.createDataFrame([("q", "a"), ("q", "b"), ("q", "z"), ("p", "a")], "query string, id string")
    facts = spark.createDataFrame([("a", 1), ("b", None)], "id string, stars int")
    found = sorted(map(tuple, verdicts.violations(answers, facts, [("min_stars", F.col("stars") >= 1)], 2).collect()), key=str)
    assert found == sorted([("q", "b", "min_stars"), ("q", "z", "not_in_facts"), ("q", None, "over_limit")], key=str)
