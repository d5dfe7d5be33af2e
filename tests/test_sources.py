import datetime as dt
import random

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postlens.operators.posts import flatten_posts, label_posts
from postlens.plans.etl import read_labelled_posts, read_posts
from postlens.sources import markup, staging
from postlens.sources.labels import label_rejects, read_labels
from postlens.sources.subjects import read_subjects_xml, subject_rejects, subject_schema, write_subjects_xml
from postlens.sources.views import read_dashboard_view, read_view, write_view


def xml(tmp_path, chunk, name, body):
    folder = tmp_path / chunk
    folder.mkdir(exist_ok=True)
    (folder / name).write_text(body, encoding="utf-8")


def writing(**fields):
    inner = "".join(f"<{tag}>{value}</{tag}>" for tag, value in fields.items())
    return f"<WRITING>{inner}</WRITING>"


def subject(subject_id, *writings):
    return f"<INDIVIDUAL>\n<ID>{subject_id}</ID>\n{''.join(writings)}\n</INDIVIDUAL>\n"


@pytest.fixture
def posts_glob(tmp_path):
    two = [
        writing(TITLE=" Hello  ", DATE="2015-05-03 01:02:03", INFO="forum", TEXT=" first\ttext  "),
        writing(TITLE="", DATE="bad date", INFO="x", TEXT="second &amp; post"),
    ]
    xml(tmp_path, "chunk1", "s1.xml", '<?xml version="1.0"?>\n' + subject("s1", *two))
    xml(tmp_path, "chunk1", "s2.xml", subject("s2", writing(TITLE="t", TEXT="")))
    xml(tmp_path, "chunk2", "s3.xml", subject("s3"))
    xml(tmp_path, "chunk10", "s1.xml", subject("s1", writing(DATE="2015-05-04 23:00:00")))
    return str(tmp_path / "chunk*" / "*.xml")


def test_posts_from_xml(spark, posts_glob):
    rows = read_posts(spark, posts_glob).orderBy("subject_id", "chunk", "pos").collect()
    got = [(r.subject_id, r.chunk, r.pos, r.title, r.date, r.source_info, r.text) for r in rows]
    assert got == [
        ("s1", 1, 0, "Hello", dt.datetime(2015, 5, 3, 1, 2, 3), "forum", "first\ttext"),
        ("s1", 1, 1, "", None, "x", "second & post"),
        ("s1", 10, 0, None, dt.datetime(2015, 5, 4, 23, 0), None, None),
        ("s2", 1, 0, "t", None, None, ""),
    ]


def test_post_schema(spark, posts_glob):
    schema = read_posts(spark, posts_glob).schema
    assert schema.simpleString() == (
        "struct<subject_id:string,chunk:int,file:string,record:bigint,pos:int,title:string,date:timestamp,"
        "source_info:string,text:string>"
    )


def test_single_chunk_scan(spark, posts_glob):
    one = posts_glob.replace("chunk*", "chunk10")
    assert [(r.subject_id, r.chunk) for r in read_posts(spark, one).collect()] == [("s1", 10)]


def test_only_single_writings(spark, tmp_path):
    """Schema inference would read such files as a struct and not as an array."""
    xml(tmp_path, "chunk1", "a.xml", subject("a", writing(TEXT="one")))
    assert [r.text for r in read_posts(spark, str(tmp_path / "chunk1")).collect()] == ["one"]


def test_narrow_read_parses_only_the_fields_asked_for(spark, posts_glob):
    posts = read_posts(spark, posts_glob, ("TEXT",))
    assert posts.columns == ["subject_id", "chunk", "file", "record", "pos", "text"]
    assert "DATE" not in posts._jdf.queryExecution().executedPlan().toString()


def test_malformed_record_hides_no_other_record(spark, tmp_path):
    body = "".join(
        [
            "<SUBJECTS>",
            subject("ok1", writing(TEXT="a")),
            subject("amp", writing(TEXT="a & b")),
            "<INDIVIDUAL><ID>open</ID><WRITING><TEXT>x</WRITING></INDIVIDUAL>",
            subject("ok2", writing(TEXT="b")),
            "</SUBJECTS>",
        ]
    )
    xml(tmp_path, "chunk1", "mixed.xml", body)
    path = str(tmp_path / "chunk1")
    assert {r.ID for r in read_subjects_xml(spark, path).collect()} == {"ok1", "ok2"}
    rejects = subject_rejects(spark, path)
    assert rejects.columns == ["record", "file", "reason"]
    assert sorted((r.record[:24], r.reason) for r in rejects.collect()) == [
        ("<INDIVIDUAL>\n<ID>amp</ID", "not well-formed"),
        ("<INDIVIDUAL><ID>open</ID", "not well-formed"),
    ]
    whole = read_subjects_xml(spark, path, corrupt=True)
    assert whole.count() == 4 and whole.schema["_corrupt_record"].dataType == T.StringType()


def test_every_opening_tag_is_a_record_or_a_reject(spark, tmp_path):
    body = "".join(
        [
            ' \n <?xml version="1.0"?>\n<INDIVIDUALS note="a">\n',
            "<INDIVIDUAL><ID>lost</ID><WRITING><TEXT>x</TEXT></WRITING>\n",
            "<INDIVIDUAL kind='k'><ID>spaced</ID><WRITING><TEXT>y</TEXT></WRITING></INDIVIDUAL\n >",
            "<INDIVIDUAL/>",
            "<INDIVIDUAL ><ID>data</ID><WRITING><TEXT><![CDATA[<b>]]></TEXT></WRITING></INDIVIDUAL>",
            "<INDIVIDUAL><ID>cut</ID><WRITING><TEXT>z</TEXT></WRIT",
        ]
    )
    xml(tmp_path, "chunk1", "a.xml", body)
    path = str(tmp_path / "chunk1")
    posts = read_posts(spark, path).select("subject_id", "text").collect()
    assert sorted(map(tuple, posts)) == [("data", "<b>"), ("spaced", "y")]
    rejected = subject_rejects(spark, path).collect()
    assert sorted(r.record[16:20] for r in rejected if r.reason == "no closing tag") == ["cut<", "lost"]
    assert len(rejected) == 2
    assert read_subjects_xml(spark, path, corrupt=True).count() == 5


SECTIONS = [
    "<INDIVIDUAL><ID>a</ID><WRITING><TEXT><![CDATA[see <INDIVIDUAL> and </INDIVIDUAL> there]]></TEXT></WRITING></INDIVIDUAL>",
    "<!-- <INDIVIDUAL><ID>hidden</ID></INDIVIDUAL> -->",
    "<INDIVIDUAL><ID>b</ID><!-- ]]> <INDIVIDUAL> --><WRITING><TEXT>plain</TEXT></WRITING></INDIVIDUAL>",
    "<INDIVIDUAL><ID>c</ID><WRITING><TEXT><![CDATA[<INDIVIDUAL><!-- <INDIVIDUAL x='1'> " + "<INDIVIDUAL>" * 30 + "]]></TEXT></WRITING>"
    "<WRITING><TEXT><![CDATA[</INDIVIDUAL>]]> tail</TEXT></WRITING></INDIVIDUAL >",
    "<INDIVIDUAL><ID>d</ID><WRITING><TEXT>last --&gt; one</TEXT></WRITING></INDIVIDUAL>",
]
SECTION_POSTS = [
    ("a", "see <INDIVIDUAL> and </INDIVIDUAL> there"), ("b", "plain"),
    ("c", "<INDIVIDUAL><!-- <INDIVIDUAL x='1'> " + "<INDIVIDUAL>" * 30), ("c", "</INDIVIDUAL> tail"), ("d", "last --> one"),
]


@pytest.mark.parametrize("split", [61, 150, 1 << 20])
def test_record_tags_in_sections(spark, tmp_path, split):
    """Sections with record tags, in splits of every kind, next to a file without any."""
    xml(tmp_path, "chunk1", "a.xml", "<SUBJECTS>\n" + "\n".join(SECTIONS) + "\n</SUBJECTS>")
    xml(tmp_path, "chunk1", "b.xml", subject("e", writing(TEXT="other file")))
    path = str(tmp_path / "chunk1")
    old = {c: spark.conf.get(c, None) for c in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        for c in old:
            spark.conf.set(c, split)
        posts = read_posts(spark, path).select("subject_id", "text").collect()
        rejected = subject_rejects(spark, path).collect()
    finally:
        for c, value in old.items():
            spark.conf.unset(c) if value is None else spark.conf.set(c, value)
    assert sorted(map(tuple, posts)) == sorted([*SECTION_POSTS, ("e", "other file")])
    assert rejected == []


def test_sections_that_are_never_closed(spark, tmp_path):
    """They hide no record behind them; one that a later record closes hides what lies between."""
    open_one = "<INDIVIDUAL><ID>o</ID><WRITING><TEXT><![CDATA[ open</TEXT></WRITING></INDIVIDUAL>"
    comment = "<INDIVIDUAL><ID>p</ID><!-- open <WRITING><TEXT>x</TEXT></WRITING></INDIVIDUAL>"
    good = [subject(f"g{i}", writing(TEXT=f"t{i}")) for i in range(4)]
    xml(tmp_path, "chunk1", "a.xml", good[0] + open_one + good[1] + comment + good[2])
    xml(tmp_path, "chunk1", "b.xml", open_one.replace("open<", "<") + good[3] + SECTIONS[0])
    found = read_posts(spark, str(tmp_path / "chunk1")).select("subject_id").collect()
    assert sorted(r.subject_id for r in found) == ["g0", "g1", "g2", "o"]
    rejected = subject_rejects(spark, str(tmp_path / "chunk1")).collect()
    assert sorted(r.record[16:17] for r in rejected) == ["o", "p"]


def test_states_equal_a_lexer(spark):
    """Maps of pieces against a character-wise lexer, for all three beginnings."""
    rng = random.Random(7)
    parts = ["<![CDATA[", "]]>", "<!--", "-->", "x", "<a>", "<!", "]]", "--", "\n"]
    values = ["".join(rng.choices(parts, k=rng.randint(0, 9))) for _ in range(400)]

    def lexed(value, state):
        at = 0
        while at < len(value):
            if state == markup.TEXT:
                found = [s for s, o in markup.OPENS.items() if value.startswith(o, at)]
                if found:
                    state, at = found[0], at + len(markup.OPENS[found[0]])
                    continue
            elif value.startswith(markup.CLOSES[state], at):
                state, at = markup.TEXT, at + 3
                continue
            at += 1
        return state

    df = spark.createDataFrame([(v,) for v in values], "value string").select("value", markup.state_map(F.col("value")).alias("m"))
    for row in df.collect():
        # A closing token may not begin with what opened the section; see "<!-->".
        if "<!-->" not in row.value:
            assert row.m == [lexed(row.value, s) for s in (markup.TEXT, markup.CDATA, markup.COMMENT)]


def test_other_encodings(spark, tmp_path):
    (tmp_path / "chunk1").mkdir()
    (tmp_path / "chunk1" / "a.xml").write_bytes(subject("é1", writing(TEXT="été")).encode("latin-1"))
    path = str(tmp_path / "chunk1")
    posts = read_posts(spark, path, encoding="ISO-8859-1").collect()
    assert [(r.subject_id, r.text) for r in posts] == [("é1", "été")]


def test_staged_tables_are_removed(spark):
    with staging.scratch(spark):
        path = staging.staging_path(spark, "t")
        assert staging.stage(spark.range(3), path).count() == 3
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        spark.read.parquet(path)


def test_large_file_is_read_by_several_tasks(spark, tmp_path):
    records = [subject(f"s{i}", writing(TEXT=f"text {i} " + "é" * 50)) for i in range(2000)]
    xml(tmp_path, "chunk1", "all.xml", "<SUBJECTS>" + "".join(records) + "</SUBJECTS>")
    conf = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(conf)
    spark.conf.set(conf, "20000")
    try:
        posts = read_posts(spark, str(tmp_path / "chunk1"))
        assert posts.rdd.getNumPartitions() > 4
        assert sorted(r.text for r in posts.collect()) == sorted(
            f"text {i} " + "é" * 50 for i in range(2000)
        )
    finally:
        spark.conf.set(conf, before)


def test_missing_path_raises(spark, tmp_path):
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        read_subjects_xml(spark, str(tmp_path / "none" / "*.xml"))


def test_xml_write_and_read(spark, tmp_path):
    rows = [("a", [("t", None, "i", 'x < y & "z"'), (None, "2020-01-01 00:00:00", "", " é\n ")]), ("b", [("", "", "", "")])]
    subjects = spark.createDataFrame(rows, subject_schema())
    write_subjects_xml(subjects, str(tmp_path / "chunk3"))
    back = read_subjects_xml(spark, str(tmp_path / "chunk*" / "*.xml")).orderBy("ID").collect()
    assert [(r.ID, [w.TEXT for w in r.WRITING]) for r in back] == [("a", ['x < y & "z"', " é\n "]), ("b", [""])]
    assert {r.chunk for r in back} == {3}


@pytest.fixture
def label_file(tmp_path):
    lines = ["subject1 1", "subject2\t0", "subject3   1 extra", " subject9  1", "subject8", "subject7 x", ""]
    path = tmp_path / "labels.txt"
    path.write_text("\n".join(lines) + "\n")
    return str(path)


def test_labels(spark, label_file):
    labels = read_labels(spark, label_file)
    assert labels.schema.simpleString() == "struct<subject_id:string,label:int>"
    assert {tuple(r) for r in labels.collect()} == {("subject1", 1), ("subject2", 0), ("subject3", 1)}


def test_label_rejects(spark, label_file):
    rejects = [r.value for r in label_rejects(spark, label_file).collect()]
    assert sorted(rejects) == ["", " subject9  1", "subject7 x", "subject8"]


def test_labelled_posts_of_files(spark, posts_glob, tmp_path):
    (tmp_path / "golden.txt").write_text("s1 1\ns3 0\nnobody 1\n")
    plain = read_labelled_posts(spark, posts_glob, str(tmp_path / "golden.txt"))
    after = label_posts(read_posts(spark, posts_glob), read_labels(spark, str(tmp_path / "golden.txt")))
    assert plain.count() == 3 and {r.label for r in plain.collect()} == {1}
    assert plain.exceptAll(after.select(plain.columns)).count() == 0 and after.count() == 3


def test_every_record_is_parsed_once(spark, posts_glob, tmp_path):
    (tmp_path / "golden.txt").write_text("s1 1\n")
    plans = [
        df._jdf.queryExecution().optimizedPlan().toString()
        for df in (
            read_posts(spark, posts_glob),
            read_labelled_posts(spark, posts_glob, str(tmp_path / "golden.txt")),
            subject_rejects(spark, posts_glob),
        )
    ]
    assert [plan.count("from_xml(") for plan in plans] == [1, 1, 1]


def test_view_formats(spark, tmp_path):
    df = spark.range(100).select(
        F.col("id").cast("int").alias("day"), F.concat(F.lit('a,"'), "id").alias("word")
    )
    for fmt in ("csv", "parquet"):
        path = str(tmp_path / fmt)
        write_view(df, path, fmt, (F.desc("day"),))
        write_view(df, path, fmt, (F.desc("day"),))
        assert len(list((tmp_path / fmt).glob(f"*.{fmt}"))) == 1
        back = read_view(spark, path, fmt, "day int, word string").collect()
        assert [r.day for r in back] == list(range(99, -1, -1))
        assert back[0].word == 'a,"99'
    with pytest.raises(ValueError):
        write_view(df, str(tmp_path / "x"), "orc")


def test_view_of_several_files_is_read_whole(spark, tmp_path):
    spark.range(10).repartition(3).write.csv(str(tmp_path / "v"), header=True)
    assert read_view(spark, str(tmp_path / "v"), "csv", "id bigint").count() == 10


def test_missing_view_raises(spark, tmp_path):
    with pytest.raises(AnalysisException):
        read_dashboard_view(spark, str(tmp_path), "dashboard_kpi")


def test_staged_table(spark):
    df = spark.range(5).withColumn("t", F.array(F.lit("a")))
    path = staging.staging_path(spark, "t")
    assert path.startswith(staging.shared_folder(spark))
    back = staging.stage(df, path, sort_by=["id"])
    assert back.dtypes == df.dtypes and back.count() == 5
    with pytest.raises(AnalysisException):
        staging.stage(df, path)



def test_flatten_keeps_what_is_asked(spark):
    df = spark.createDataFrame([("a", [("x",)], 7)], "ID string, WRITING array<struct<TEXT:string>>, chunk int")
    assert flatten_posts(df, keep=["chunk"]).collect() == [("a", 7, 0, "x")]


def _cuts(spark, values):
    df = spark.createDataFrame(list(enumerate(values)), "i int, value string")
    return [r.cut for r in df.select("i", markup.cut(F.col("value"), r"</INDIVIDUAL\s*>").alias("cut")).orderBy("i").collect()]


def test_cut_at_the_first_closing_tag_outside_of_sections(spark):
    end = "</INDIVIDUAL >"
    cases = {
        f"a<b>{end}c{end}": "a<b>",
        f"a<![CDATA[{end}]]>b{end}c": f"a<![CDATA[{end}]]>b",
        f"a<!-- {end} --><![CDATA[<!--]]>{end}--></INDIVIDUAL>": f"a<!-- {end} --><![CDATA[<!--]]>",
        f"a<!-- never closed {end} b": "a<!-- never closed ",
        f"<![CDATA[{end}]]>": None,
        f"{end}<!-- -->": "",
        "a<!-- --></INDIVIDUALS>": None,
        f"a\n<![CDATA[\n{end}\n]]>\n{end}": f"a\n<![CDATA[\n{end}\n]]>\n",
        None: None,
    }
    assert _cuts(spark, cases) == list(cases.values())
    long = "x<b>" * 300_000 + f"<!-- {'y' * 300_000} -->"
    assert _cuts(spark, [f"{long}{end}z"]) == [long]


def test_a_text_is_matched_once_to_cut_it(spark):
    """Sections are not split off anew for each of a text's parts."""
    plan = spark.range(1).select(markup.cut(F.concat(F.lit("a"), "id"), "</A>").alias("cut"))._jdf.queryExecution().analyzed().toString()
    assert plan.count("CDATA") == 1


PIECE = "file string, block long, at long, value string"


def _whole_pieces(spark, rows):
    pieces = spark.createDataFrame(rows, PIECE).coalesce(1).select("value", "file", "block", "at")
    return markup.whole_pieces(pieces, "<T")


def test_tables_of_pieces_are_not_broadcast(spark, monkeypatch):
    """A stored table of many pieces is small on disk, and broke the driver when it was broadcast."""
    plans = []
    note = lambda df: plans.append(df._jdf.queryExecution().executedPlan().toString())
    monkeypatch.setattr(markup, "stage", lambda df, path: note(df) or staging.stage(df, path))
    rows = [("f", i // 40, i, v) for i, v in enumerate(["a <!--", "b", "--> c", "d"] * 40)]
    made = _whole_pieces(spark, rows)
    note(made)
    joins = [line for plan in plans for line in plan.splitlines() if "BroadcastHashJoin" in line]
    assert joins and not any("BuildLeft" in line for line in joins)
    assert len(made.collect()) == 80


def test_records_within_a_split_are_joined_where_they_are_read(spark):
    rows = [("f", i // 400, i, v) for i, v in enumerate(["a <![CDATA[", "b", "]]> c", "d"] * 400)]
    pieces = spark.createDataFrame(rows, PIECE).coalesce(1).withColumns({"opens_1": F.lit(True), "opens_2": F.lit(False)})
    rows = markup._joined(pieces, "<T").collect()
    whole = [r.value.decode() for r in rows if r.whole]
    # Of 400 pieces, a later split's first three may belong to the record before; its last one may go on.
    assert whole.count("a <![CDATA[<Tb<T]]> c") == 400 - 3 and whole.count("d") == 400 - 4
    assert len(rows) - len(whole) == 3 * 3 + 4


def test_whole_pieces_equal_a_walk_over_each_file(spark):
    rng = random.Random(3)
    tokens = ["<!--", "-->", "<![CDATA[", "]]>"]
    rows = []
    for file in range(30):
        values = ["".join(rng.choices(["x", "\n", "é", *(tokens if rng.random() < 0.4 else [])], k=4)) for _ in range(60)]
        cuts = sorted(rng.sample(range(1, 60), 4))
        rows += [(f"f{file}", 100 * sum(i >= c for c in cuts), i, v) for i, v in enumerate(values)]
    made = sorted((r.file, r.value) for r in _whole_pieces(spark, rows).collect())
    df = spark.createDataFrame(rows, PIECE)
    maps = {(r.file, r["at"]): r.m for r in df.select("file", "at", markup.state_map(F.col("value")).alias("m")).collect()}
    want = []
    for file in {r[0] for r in rows}:
        values, state, records = [r[3] for r in rows if r[0] == file], markup.TEXT, []
        for i, value in enumerate(values):
            if state == markup.TEXT:
                records.append([])
            records[-1].append(value)
            end = maps[file, i][state]
            never = end != markup.TEXT and not any(markup.CLOSES[end] in v for v in values[i + 1 :])
            state = markup.TEXT if state == markup.TEXT and never else end
        want += [(file, "<T".join(r)) for r in records]
    assert made == sorted(want) and len(made) < len(rows)
