"""Parsing of system-log lines; the cases are those of FIXTURES.md."""

import random
import re

import pytest
from pyspark.sql import functions as F

from logloom.functions import fixed, text
from logloom.operators import system_log

COMPONENT = "|".join(fixed.COMPONENTS)
LONG_ID = "0000000a@2016/9/28:20:30:31 hr 0x80070002 ref @12ab34 @123456"
CASES = [
    # line, Date, Time, Level, Component, EventTemplate, has a valid timestamp
    (
        "2021-05-17 08:15:42, Info                  CBS    Cache warmed: region north, ready: yes",
        ("2021-05-17", "08:15:42", "Info", "CBS", "Cache warmed: region north, ready: yes", True),
    ),
    (
        "2021-05-17 08:15:41 Info    CBS         Worker begins its first round.",
        ("2021-05-17", "08:15:41", "", "CBS", "Worker begins its first round.", True),
    ),
    ("   continuation line CBS", None),
    (
        f"2016-09-28 04:30:31, Error                 CSI    {LONG_ID}",
        (
            "2016-09-28", "04:30:31", "Error", "CSI",
            "0000000a@<NUM>/<NUM>/<NUM>:<NUM>:<NUM>:<NUM> hr <HEX> ref @<ID> @<NUM>", True,
        ),
    ),
    ("2016-09-28 04:30:31, Info  other source", ("2016-09-28", "04:30:31", "Info", "", "", True)),
    ("2016-13-45 04:30:31, Info CBS x", ("2016-13-45", "04:30:31", "Info", "CBS", "x", False)),
    ("2016-09-28, Info CBS no time", ("2016-09-28", "", "Info", "CBS", "no time", False)),
    (
        "2016-09-28 04:30:31, Info CBSX CSI  real content",
        ("2016-09-28", "04:30:31", "Info", "CBS", "real content", True),
    ),
    (
        "2016-09-28 04:30:31, Notice CBS retry, Error in CSI  again",
        ("2016-09-28", "04:30:31", "Error", "CBS", "retry, Error in CSI  again", True),
    ),
    ("2016-09-28 04:30:31, info cbs x", ("2016-09-28", "04:30:31", "", "", "", True)),
    ("2016-09-28 04:30:31, Info CSI CBS y", ("2016-09-28", "04:30:31", "Info", "CSI", "CBS y", True)),
    ("2016-09-28 04:30:31, Info CBS", ("2016-09-28", "04:30:31", "Info", "CBS", "", True)),
    ("", None),
]


def test_lines_of_the_format_description(lines_of):
    for line, expected in CASES:
        rows = system_log.with_timestamp(system_log.parse_system_log(lines_of(line))).collect()
        if expected is None:
            assert rows == []
            continue
        (row,) = rows
        found = (row.Date, row.Time, row.Level, row.Component, row.EventTemplate, row.Timestamp is not None)
        assert found == expected, line


@pytest.mark.parametrize(
    "content, template",
    [
        ("0xFFg", "<HEX>g"),
        ("a_12 v2", "a_12 v2"),
        ("@12ab34 @123456 @12345", "@<ID> @<NUM> @<NUM>"),
        ("  12  ", "<NUM>"),
        ("\t7\t", "\t<NUM>\t"),
        ("0x 0x1 x0x2", "0x <HEX> x<HEX>"),
        ("", ""),
    ],
)
def test_templates(spark, content, template):
    row = system_log.with_event_template(spark.createDataFrame([(content,)], "Content string")).first()
    assert row.EventTemplate == template


def test_fields_agree_with_whole_line_patterns(lines_of):
    """Short cuts (header slices, substring checks) must not change what the patterns find in the whole line."""
    lines = lines_of(*[line for line, _ in CASES], "CSICBS CSI x", "x, Debug, Error CSIx CBS CSI  later")
    value = F.col("value")
    differing = lines.select(
        text.leading_date(value).alias("d1"),
        F.regexp_extract(value, fixed.DATE_PATTERN, 1).alias("d2"),
        text.first_word(value, fixed.COMPONENTS).alias("c1"),
        F.regexp_extract(value, f"({COMPONENT})", 1).alias("c2"),
        text.text_after_word(value, fixed.COMPONENTS).alias("r1"),
        F.regexp_extract(value, rf"(?:{COMPONENT})\s+(.*)", 1).alias("r2"),
    ).filter("d1 <> d2 OR c1 <> c2 OR r1 <> r2")
    assert differing.count() == 0


def test_other_components_and_levels(lines_of):
    parsed = system_log.parse_system_log(
        lines_of("2020-01-01 00:00:00, Fatal   DISM   it broke"), components=("DISM", "DPX"), levels=("Fatal",)
    ).first()
    assert (parsed.Level, parsed.Component, parsed.Content) == ("Fatal", "DISM", "it broke")


def test_timestamps_agree_with_a_strict_format(spark):
    dates = ["2016-02-29", "2015-02-29", "2016-13-01", "2016-00-10", "0000-01-01", "9999-12-31", "", "2016-1-1", "x"]
    times = ["00:00:00", "23:59:59", "24:00:00", "12:60:00", "12:00:60", "", "1:00:00", "12:00"]
    pairs = spark.createDataFrame([(d, t) for d in dates for t in times], "Date string, Time string")
    strict = F.try_to_timestamp(F.concat_ws(" ", "Date", "Time"), F.lit("yyyy-MM-dd HH:mm:ss")).cast("timestamp_ntz")
    checked = system_log.with_timestamp(pairs).withColumn("Strict", strict)
    assert checked.filter("NOT Timestamp <=> Strict").collect() == []
    assert checked.filter("Timestamp IS NOT NULL").count() == 6


def test_hours_do_not_move_with_the_session_zone(spark, lines_of):
    """02:30 does not exist on this day in New York."""
    lines = lines_of("2016-03-13 02:30:00, Info CBS x")
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        hour = system_log.with_hour(system_log.parse_system_log(lines)).first().Hour_Window
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert str(hour) == "2016-03-13 02:00:00"


def parsed_by_hand(line):
    """The six columns, field by field from the whole line; None for a line that is dropped."""

    def find(pattern, group=1):
        found = re.search(pattern, line)
        return found.group(group) if found else ""

    if not find(fixed.DATE_PATTERN):
        return None
    content = template = find(rf"(?:{COMPONENT})\s+(.*)")
    for pattern, replacement, _ in fixed.TEMPLATE_RULES:
        template = re.sub(pattern, replacement, template)
    return (
        find(fixed.DATE_PATTERN),
        find(fixed.TIME_PATTERN),
        find(rf",\s*({'|'.join(fixed.LEVELS)})"),
        find(f"({COMPONENT})"),
        content,
        template.strip(" "),
    )


def test_random_lines_against_a_parser_by_hand(lines_of):
    """Lines glued together from pieces that look like fields, in any order and number."""
    rng = random.Random(11)
    pieces = [
        "2016-09-28", "2016-9-28", " ", "  ", "\t", "04:30:31", "4:30", ",", ", ", "Info", "Error", "error", "Verbose",
        "CBS", "CSI", "CSX", "C", "CBSCSI", "0x", "0x1F", "0xg", "@", "@123456", "@12ab34", "@12ab3", "12", "a_1", "007",
        "-", "_", ".", "x", "{k: 1}", "$1", "\\\\",
    ]
    lines = []
    for _ in range(4000):
        start = "2016-09-28 04:30:31" if rng.random() < 0.6 else ""
        lines.append(start + "".join(rng.choices(pieces, k=rng.randrange(14))))
    expected = [row for row in map(parsed_by_hand, lines) if row is not None]
    found = [tuple(row) for row in system_log.parse_system_log(lines_of(*lines)).collect()]
    assert len(expected) > 2000 and sorted(found) == sorted(expected)


ODD_WORDS = [["C++", "CSI"], ["C", "C++"], ["C++", "C"], ["]x", "^X", "a-c"], ["a.b", "(z", "[q]", "\\d", "$", "{2}", "*", "?"], ["é|ü", "A"]]


@pytest.mark.parametrize("words", ODD_WORDS)
def test_words_are_literal(spark, words):
    heads = [f"2020-01-01 00:00:00, Info {w} hello {v}  tail" for w in [*words, "C+", "x", "d", "aXb", ""] for v in [*words, "-"]]
    parsed = system_log.parse_system_log(spark.createDataFrame([(h,) for h in heads], "value string").coalesce(1), words)
    for line, row in zip(heads, parsed.collect()):
        found = [(line.find(w, at), n, w) for n, w in enumerate(words) for at in range(len(line)) if line.startswith(w, at)]
        assert row.Component == (min(found)[2] if found else ""), line
        ends = sorted((at, n, w) for n, w in enumerate(words) for at in range(len(line)) if line.startswith(w, at) and line[at + len(w) :][:1] == " ")
        content = line[ends[0][0] + len(ends[0][2]) :].lstrip(" ") if ends else ""
        assert row.Content == content, line


@pytest.mark.parametrize("words", [[], [""], ["a", ""]])
def test_empty_words_are_refused(lines_of, words):
    with pytest.raises(ValueError):
        system_log.parse_system_log(lines_of("2020-01-01 00:00:00, Info x"), words)
