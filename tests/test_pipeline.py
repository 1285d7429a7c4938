import json
import random
import re
import unicodedata
from datetime import datetime as dt
from difflib import SequenceMatcher

import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quirework.functions import clean, codes
from quirework.operators import quality, statistics, tables, textdiff
from quirework.plans import export
from quirework.sources import readers, writers
from quirework.streaming import resume, steps


def _one(spark, values, column):
    df = spark.createDataFrame([(k, v) for k, v in enumerate(values)], "k int, t string")
    return [r[1] for r in sorted(df.select("k", column.alias("v")).collect())]


def _by_scan(s):
    """The line cleaner with the language's own regular expressions."""
    s = unicodedata.normalize("NFKC", s).strip()
    for a, b in clean.LINE_RULES:
        a = a.replace("(?U)", "").replace(r"([^\p{L}\p{N}_])\1+", r"(\W)\1+")
        s = re.sub(a, re.sub(r"\$(\d)", r"\\\1", b), s)
    return s.strip()


def test_line_cleaner(spark):
    cases = ["(I'86) a  b", "(1†) ½ mile", "x–—y: z", "-| ; -┳;", "(☉), (#)", "a  b", "ﬁne ..", "", None, "\x07bell\x9f"]
    want = ["(l 86) a b", "(l t) 1/2 mile", "x-y; z", "-◊; -△;", "(♁), (‡)", "a b", "fine .", "", None, "bell"]
    got = _one(spark, cases, clean.clean_line(F.col("t")))
    assert got == want
    rng = random.Random(1)
    alphabet = "ab1l(I')-–—:;.,½⁄  \t♁δ#◊|┳△★▼éÅ"
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(0, 25))) for _ in range(300)]
    assert _one(spark, texts, clean.clean_line(F.col("t"))) == [_by_scan(t) for t in texts]


def test_record_cleaner_and_small_functions(spark):
    assert _one(spark, ["“a” ​…  b ", "© x\ty", None], clean.clean_record(F.col("t"))) == ['"a" ... b', "(c) x\ty", None]
    assert _one(spark, ["abc", "a$b%", None], clean.unexpected(F.col("t"))) == ["", "$", None]
    assert _one(spark, ["a", clean.SKIPPED, None], clean.is_readable(F.col("t"))) == [True, False, True]
    assert _one(spark, ["a- b\n-c"], clean.squeeze(F.col("t"))) == ["abc"] and _one(spark, ["offi-\n ce"], clean.join_broken(F.col("t"))) == ["office"]


def test_json_cleaner(spark):
    df = spark.createDataFrame([('{"“k”": ["a\u200b  b", 1, null, {"x": "…"}]}',), ("no “json”",), (None,), ("[" * 5000,)], "t string")
    got = [r[0] for r in df.select(clean.clean_json("t")).collect()]
    assert json.loads(got[0]) == {'"k"': ["a b", 1, None, {"x": "..."}]} and got[1:3] == ['no "json"', None] and got[3] == "[" * 5000


def test_codes(spark):
    years = ["95", "06", "6", "1895", "-1", "", None, "'11", "195"]
    assert _one(spark, years, codes.full_year(F.col("t"), 18)) == [1895, 1906, 1906, 1895, None, None, None, 1911, None]
    assert _one(spark, ["-1", "-2", "-3", "95", "", None], codes.licence_status(F.col("t"))) == ["earlier", "unknown", "exempt", "year", "none", "none"]
    assert [tuple(x) for x in _one(spark, ["Ala.4,'11", "N.Y.5", "", None], codes.school_parts(F.col("t")))] == [("ALA", "4", "11"), ("N.Y", "5", None), (None, None, None), (None, None, None)]
    assert _one(spark, ["True", "False", None, "x"], codes.flag(F.col("t"))) == [1, 0, 0, 0]
    assert _one(spark, ["▼G", "▼", "▽", None], codes.military_name(F.col("t"))) == ["National Guard", "Army Reserve", "▽", None]
    assert _one(spark, ["New York", "Missouri", "West Virginia"], codes.publication_short(F.col("t"))) == ["NYor", "Miss", "WVir"]
    keys = _one(spark, ["a_b_New York_p01_r00_c002.jpg", "too_short", None], codes.parse_request_key(F.col("t")))
    assert tuple(keys[0]) == ("New York", 1, 0, 2) and keys[1:] == [None, None]
    assert _one(spark, ["McKAY, J.", "Mac Kay", ""], codes.member_by_capitals(F.col("t"))) == [True, False, True]


def test_tables(spark, rows):
    a = spark.createDataFrame([(1, "x"), (2, None), (None, "z")], "k int, t string")
    b = spark.createDataFrame([(1, "x"), (3, "y")], "k int, t string")
    assert rows(tables.unfinished(a, [b, b.limit(0)], [("k", "k")])) == sorted([(2, None), (None, "z")], key=repr)
    assert rows(tables.one_sided(a, b, ["k"], ("no b", "no a"))) == sorted([(2, "no b"), (None, "no b"), (3, "no a")], key=repr)
    assert rows(tables.look_up(a, "k", b, "k", {"name": "t"})) == sorted([(1, "x", "x"), (2, None, ""), (None, "z", "")], key=repr)
    assert rows(tables.counts_differ(a, b, ["k"], "t")) == sorted([(None, 1, 0), (3, 0, 1)], key=repr)
    ids = spark.createDataFrame([("a_1",), ("a_2",), ("a_6",), ("a_2",), ("x",)], "id string")
    assert rows(tables.missing_numbers(ids, "id")) == [(3, 5)] and rows(tables.repeated_ids(ids, "id")) == [("a_2", 2)]
    assert rows(tables.in_batches(ids, ["id"], 2), "batch_id") == [(0,), (0,), (1,), (1,), (2,)]
    assert rows(tables.keep_first(ids.withColumn("v", F.lit(1)), ["id"], ["v"])) == [("a_1", 1), ("a_2", 1), ("a_6", 1), ("x", 1)]
    side = tables.side_by_side(a, b, ["k"], ["k"], [])
    assert side.count() == 3
    lines = spark.createDataFrame([(1, "a", 0.5), (2, "b", 0.6)], "k int, text string, conf double")
    fixed = tables.corrected(lines, spark.createDataFrame([(2, "B")], "k int, text string"), "k")
    assert rows(fixed) == [(1, "a", 0.5), (2, "B", 1.0)]
    sample = rows(tables.sample_exact(ids, 3, ["id"], "s"))
    assert len(sample) == 3 and sample == rows(tables.sample_exact(ids.repartition(3), 3, ["id"], "s"))
    assert tables.sample_exact(ids, 99, ["id"], "s").count() == 5


def test_statistics(spark):
    a = spark.createDataFrame([(1, "x", None), (2, "y", 1), (3, "z", 2)], "k int, t string, n int")
    b = spark.createDataFrame([(1, "x", None), (2, "Y", 1), (3, "z", None)], "k int, t string, n int")
    r = {x.grp: x for x in statistics.error_rates(a, b, "k", ["t", "n"]).collect()}
    assert (r["t"].n_errors, r["n"].n_errors, r["(cells)"].n, r["(rows)"].n_errors) == (1, 1, 6, 2)
    assert abs(r["t"].moe_95 - 1.96 * ((1 / 3) * (2 / 3) / 3) ** 0.5) < 1e-12
    c = statistics.chi_square(spark.createDataFrame([("g", 1000, 20), ("h", 1000, 5)], "grp string, n bigint, n_errors bigint")).orderBy("grp").collect()
    assert abs(c[0].chi2 - (225 / 5 + 225 / 995)) < 1e-9 and c[0].significant == "higher" and c[1].p_value == 1.0 and c[1].significant == ""
    assert statistics.error_rates(a.limit(0), b, "k", ["t"]).where("grp = 't'").first().error_rate is None


def test_text_changes(spark):
    pairs = [(1, "the office here", "the offlce here!"), (2, "same", "same"), (3, None, "x"), (4, "ab" * 300, "ab" * 150 + "Z" + "ab" * 150)]
    df = spark.createDataFrame(pairs, "k int, a string, b string")
    got = textdiff.text_changes(df, "k", "a", "b")
    for key in (1, 3, 4):
        a, b = next((x or "", y or "") for k, x, y in pairs if k == key)
        want = [(t, a[i:j], b[k:m]) for t, i, j, k, m in SequenceMatcher(None, a, b).get_opcodes() if t != "equal"]
        assert [(r.change, r.text_in, r.text_out) for r in got.where(f"key = {key}").orderBy("change_no").collect()] == want
    shown = got.where("key = 1 and change_no = 1").select(textdiff.in_braces(F.col("before_in"), F.col("text_in"), F.col("text_out"), F.col("after_in"))).first()[0]
    assert shown == "the off{i}ce here"
    assert {r.change: r.n for r in textdiff.change_summary(got.where("key < 4")).collect()} == {"replace": 1, "insert": 2}


def test_log(spark):
    log = "ERROR: 2 lines dropped for Ala - 1.2 (see: \ntext_in: a b\ntext_out: a c\nERROR: other\nx\nERROR: lines dropped for Me - 3.0 (y: text_in: q\ntext_out: r"
    df = spark.createDataFrame([(log,), ("none",), (None,)], "t string")
    got = [tuple(r) for r in df.select(F.explode(textdiff.dropped_pairs(F.col("t"))).alias("p")).select("p.*").collect()]
    assert got == [("Ala - 1.2", "a b", "a c"), ("Me - 3.0", "q", "r")]


def test_quality(spark):
    at = "line_id bigint, pub string, page int, col int, line_no int, text string, conf double, x int, y int, width int, height int"
    lines = spark.createDataFrame([(k, "P", 1, k % 2, k, "t", 0.9, 0, 10 * k, 5, 10) for k in range(30)], at)
    e = "row_id bigint, entry_id string, publication string, page_number int, col_no int, entry_type string, full_text string"
    entries = spark.createDataFrame([(1, "P_1", "P", 1, 0, "CITY", "c"), (2, "P_2", "P", 1, 0, "UNKNOWN", "NUMBER OF X"), (3, "P_3", "P", 1, 0, "UNKNOWN", "?"), (4, "P_9", "P", 1, 0, "DOC", "d")], e)
    found = quality.all_checks(lines, entries, entries.where("entry_type = 'CITY'"), entries.where("entry_type = 'DOC'")).collect()
    kinds = {(r.check_name, r.place): (r.expected, r.observed) for r in found}
    assert kinds["columns_per_page", "P.1"] == ("3", "2") and kinds["one_state", "P"] == ("1", "0") and kinds["unknown_entries", "P"] == ("0", "1")
    assert kinds["column_coverage", "P.1.1"][1] == "missing from classified" and kinds["missing_numbers", "2"][1] == "7" and kinds["doctor_share", "P"][1] == "0.5"


def test_sources_and_sinks(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"pub":"A","page":1,"col":0,"text":"x ▼","conf":0.9}\n\n{bad\n{"pub":"A","page":1,"col":0,"text":null}\n')
    (tmp_path / "b.jsonl").write_text('{"pub":"B","page":1,"col":0,"text":"y"}\n')
    got = readers.with_order(readers.read_json_lines(spark, f"{tmp_path}/*.jsonl")).orderBy("row_id").collect()
    assert [(r.row_id, r.pub, r.text, r[readers.BAD]) for r in got] == [(1, "A", "x ▼", None), (2, None, None, "{bad"), (3, "A", None, None), (4, "B", "y", None)]
    meta = [{"source_pdf": "s", "pub_id": "A", "pages": [{"page_num": 1, "snippets": [{"path": "p", "x_offset": 1, "column": 2}]}, {"page_num": 2, "snippets": []}]}]
    (tmp_path / "m.json").write_text(json.dumps(meta))
    flat = readers.flat_metadata(readers.read_metadata(spark, f"{tmp_path}/m.json")).collect()
    assert [tuple(r) for r in flat] == [("A", 1, 2, "p", 1, 0), ("A", 2, 0, None, 0, 0)]
    df = spark.createDataFrame([("a\nb", 'q"u', None)], "a string, b string, c int")
    writers.write_csv(df, f"{tmp_path}/csv")
    assert [tuple(r) for r in readers.read_csv(spark, f"{tmp_path}/csv", "a string, b string, c int").collect()] == [("a\nb", 'q"u', None)]
    writers.write_json_lines(df, f"{tmp_path}/json")
    writers.write_json_lines(df, f"{tmp_path}/json", append=True)
    assert spark.read.json(f"{tmp_path}/json").count() == 2
    writers.make_empty(df, f"{tmp_path}/t")
    writers.append_table(df, f"{tmp_path}/t")
    assert spark.read.parquet(f"{tmp_path}/t").count() == 1
    writers.split_output(df, F.col("c").isNotNull(), f"{tmp_path}/good", f"{tmp_path}/bad", "b")
    assert spark.read.parquet(f"{tmp_path}/good").count() == 0 and spark.read.text(f"{tmp_path}/bad").first()[0] == 'q"u'
    (tmp_path / "i.jpg").write_bytes(b"x" * 900)
    (tmp_path / "j.jpg").write_bytes(b"x" * 90)
    assert readers.read_images(spark, f"{tmp_path}/*.jpg").count() == 1
    assert readers.read_whole(spark, f"{tmp_path}/b.jsonl").first().text.startswith('{"pub"')


def test_boxes_and_answers(spark):
    boxes = ['{"bbox":[1,2,3,4]}', '{"bbox":{"x":5,"y":6,"width":7,"height":8}}', '{"x":9,"y":10,"width":11,"height":12}', "bad", None]
    assert [tuple(b) for b in _one(spark, boxes, readers.box_of(F.col("t")))] == [(1, 2, 3, 4), (5, 6, 7, 8), (9, 10, 11, 12), (None,) * 4, (None,) * 4]
    answers = ['[{"text":"a"}]', '{"lines":[{"text":"b"}]}', '{"entries":[{"text":"c"}]}', "{", None]
    got = _one(spark, answers, readers.response_items(F.col("t")))
    assert [[x.text for x in g] if g else g for g in got[:3]] == [["a"], ["b"], ["c"]] and not got[3] and not got[4]


def test_runner_keeps_what_fails(spark):
    requests = spark.createDataFrame([(k, f"t{k}") for k in range(7)], "k int, t string").coalesce(1)
    schema = T.StructType.fromDDL("k int, n int")

    def extract(batch: pd.DataFrame) -> pd.DataFrame:
        if (batch["k"] == 4).any():
            raise ValueError("poison")
        return pd.DataFrame({"k": batch["k"], "n": batch["t"].str.len()})

    good, bad = resume.failed_rows(resume.answered(requests, schema, extract, size=2))
    assert sorted(r.k for r in good.collect()) == [0, 1, 2, 3, 6] and sorted(r.k for r in bad.collect()) == [4, 5]
    b = resume.Backoff(first=1, most=4)
    assert [b.after(False) for _ in range(6)] == [1, 2, 2, 4, 4, 4] and b.after(True) == 1


def test_stream_restarts_without_loss_or_repeat(spark, tmp_path):
    (tmp_path / "in").mkdir()
    go = lambda: resume.follow_files(spark, f"{tmp_path}/in", "k int, t string", f"{tmp_path}/out", f"{tmp_path}/cp", lambda d: d.where("k > 0"), ["k"])
    (tmp_path / "in" / "1.json").write_text('{"k":1,"t":"a"}\n{"k":0,"t":"b"}\n')
    go()
    (tmp_path / "in" / "2.json").write_text('{"k":1,"t":"again"}\n{"k":2,"t":"c"}\n')
    go()
    go()
    assert sorted(tuple(r) for r in spark.read.parquet(f"{tmp_path}/out").collect()) == [(1, "a"), (2, "c")]


def test_export(spark):
    d = "row_id bigint, entry_id string, city_id string, publication string, name string, ama_member boolean, col boolean, birth_year string, ama_fellow boolean, schools string, license_year string, not_in_practice boolean, address string, office string, hours string, societies string, specialty string, military string, other_info string, loaded_at timestamp_ntz"
    doctors = spark.createDataFrame(
        [(1, "NYor_001_00_000003", "c1", "New York", "KAY", True, None, "6", True, "Ala.4,'11", "-1", False, "a", None, "9-11;30", "A1", "Path★", "▼N", None, dt(2025, 1, 1)), (2, None, None, None, *[None] * 16)], d
    )
    cities = spark.createDataFrame([("c1", "Town", "Shire"), ("c1", "Town", "Shire")], "entry_id string, name string, county_name string")
    got = export.export_wide(doctors, cities).collect()
    assert len(got[0].asDict()) == 42 and len(got) == 2
    r = next(x for x in got if x["physician.name"] == "KAY")
    assert (r["unique.id"], r["orig.city"], r["school.code"], r["graduation.date"], r["license.date"], r["birth.date"]) == ("NEW YORK_001_00_000003", "Town", "ALA.4", "1911", None, "1906")
    assert (r["hours"], r["specialties"], r["medical.corps"], r["ama.fellow"], r["race.black"]) == ('="9-11:30"', "Path*", "Navy Reserve", 1, 0)


def test_answers_cut_off_are_continued_and_bad_ones_set_apart(spark, rows):
    def extract(batch):
        full = batch["prompt"].str.split("=").str[0].map({"a": "one two three", "b": "x", "c": "unsafe"})
        left = [f[len(p.split("=")[1]) :] for f, p in zip(full, batch["prompt"])]
        return pd.DataFrame({"key": batch["key"], "answer": [t[:5] for t in left], "finish_reason": ["SAFETY" if t == "unsafe" else "MAX_TOKENS" if len(t) > 5 else "STOP" for t in left]})

    requests = spark.createDataFrame([(k, f"{k}=") for k in "abc"], "key string, prompt string")
    schema = T.StructType([T.StructField("key", T.StringType()), T.StructField("answer", T.StringType())])
    got = resume.answered(requests.coalesce(1), schema, resume.continued(extract, most=5), size=3)
    assert rows(got, "key", "answer", "failed") == [("a", "one two three", False), ("b", "x", False), ("c", "unsaf", True)]
    once = resume.answered(requests.coalesce(1), schema, resume.continued(extract, most=1), size=3)
    assert rows(once.where("failed"), "key") == [("a",), ("c",)]


def test_waves_of_bounded_size_go_on_where_they_stopped(spark, rows, tmp_path):
    data, sizes = spark.createDataFrame([(k,) for k in range(23)], "k int"), []
    target = f"{tmp_path}/out"

    def ask(wave):
        sizes.append(wave.count())
        return wave.withColumn("answer", F.col("k") * 2)

    pending = lambda done: data if done is None else data.join(done, "k", "left_anti")
    assert resume.in_waves(spark, pending, ask, target, ["k"], size=2, in_flight=5) == 3 and sizes == [10, 10, 3, 0]
    assert resume.in_waves(spark, pending, ask, target, ["k"], size=2, in_flight=5) == 0
    assert rows(spark.read.parquet(target), "k", "answer") == sorted([(k, 2 * k) for k in range(23)], key=repr)


def test_the_steps_of_the_pipeline(spark, rows):
    snippets = spark.createDataFrame([("P", 1, c, f"P_{c}.jpg") for c in range(3)], "pub string, page int, col int, path string")
    done = snippets.where("col = 0").select("pub", "page", "col")
    ocr = steps.OcrStep(lambda _: snippets, lambda _: done)
    answer = lambda b: pd.DataFrame({"key": b["key"], "answer": [f'[{{"text": "{p[-7:]}", "x": 1}}, {{"text": "z", "x": 2}}]' for p in b["prompt"]], "finish_reason": "STOP"})
    lines = ocr.lines(resume.BatchRunner(ocr, answer).run(spark, ["key"]))
    assert rows(lines, "pub", "page", "col", "line_no", "text", "x") == [("P", 1, c, k, t, k + 1) for c in (1, 2) for k, t in ((0, f"P_{c}.jpg"), (1, "z"))]
    classify = steps.ClassifyStep(lambda _: lines, lambda _: spark.createDataFrame([("P|1|1",)], "key string"))
    assert rows(classify.requests(resume.BatchRunner(classify, answer).pending(spark))) == [("P|1|2", "0: P_2.jpg\n1: z")]
    entries = spark.createDataFrame([("e1", "P", "DOC", "t1"), ("e2", "P", "CITY", "t2"), ("e3", "P", "DOC", "t3")], "entry_id string, publication string, entry_type string, full_text string")
    parse = steps.EntryStep(lambda _: entries, lambda _: entries.where("entry_id = 'e3'").select("entry_id", "publication"))
    assert rows(parse.requests(resume.BatchRunner(parse, answer).pending(spark))) == [("e1", "P", "t1")]


def test_batches_and_gaps_over_ranges(spark, rows):
    ids = spark.range(1, 1001).where("id % 97 <> 0 and id not between 500 and 520").select(F.concat(F.lit("x"), "id").alias("k"), F.col("id").alias("n")).repartition(7)
    got = tables.in_batches(ids, ["n"], 50).groupBy("batch_id").agg(F.count("*").alias("c"), F.min("n").alias("lo"), F.max("n").alias("hi")).orderBy("batch_id").collect()
    assert all(r.c == 50 for r in got[:-1]) and all(a.hi < b.lo for a, b in zip(got, got[1:])) and sum(r.c for r in got) == ids.count()
    assert rows(tables.missing_numbers(ids, "k")) == sorted([(n, n) for n in range(97, 1000, 97)] + [(500, 520)], key=repr)


def test_lookups_of_unique_keys(spark, rows):
    t = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b")], "k int, v string")
    df = spark.createDataFrame([(1,), (3,), (None,)], "k int")
    assert rows(tables.look_up(df, "k", t, "k", {"w": "v"}, unique=True), "w") == [("",), ("",), ("a",)]
    with pytest.raises(Exception, match="several rows"):
        tables.look_up(df, "k", t.union(spark.createDataFrame([(1, "z")], t.schema)), "k", {"w": "v"}, unique=True).collect()


def test_columns_without_lines_count(spark, rows):
    lines = spark.createDataFrame([("P", 1, 0, k) for k in range(6)] + [("P", 1, 1, k) for k in range(3)], "pub string, page int, col int, line_id int")
    columns = spark.createDataFrame([("P", 1, c) for c in range(3)], "pub string, page int, col int")
    got = rows(statistics.column_deviation(lines, ("pub", "page"), "col", "line_id", columns))
    assert got == [("P", 1, 3.0, 3.0)] and rows(statistics.column_deviation(lines, ("pub", "page"), "col", "line_id")) == [("P", 1, 4.5, 1.5)]


def test_error_function(spark):
    import math

    xs = [0.0, 1e-6, 0.1, 0.5, 1.0, 1.386, 2.0, 4.0, 8.0]
    for r in spark.createDataFrame([(x,) for x in xs], "x double").select("x", statistics.erfc(F.col("x")).alias("e")).collect():
        assert abs(r.e - math.erfc(r.x)) <= 1.3e-7 * math.erfc(r.x)


def test_changes_with_and_without_junk(spark):
    a, b = "ab" * 150 + "x", "ab" * 150 + "y"
    df = spark.createDataFrame([(1, a, b)], "k int, a string, b string")
    assert textdiff.text_changes(df, "k", "a", "b", junk=False).select("text_in", "text_out").collect() == [("x", "y")]
