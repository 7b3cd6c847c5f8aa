"""Known values: ratings, records, ranks, page lines, names."""

from pyspark.sql import functions as F

from duelframe.functions import lines, names, numbers, times
from duelframe.operators import entities, nested, quotes, ranks, ratings, teams


def one(spark, *cols):
    return spark.range(1).select(*[c.alias(f"c{i}") for i, c in enumerate(cols)]).first()


def test_rating_difference(spark):
    row = one(spark, lines.rating_diff(F.lit(85.0), F.lit(82.5), F.lit(1.5)),
              lines.side_view(F.lit(-3.5), F.lit("HOME")), lines.side_view(F.lit(-3.5), F.lit("AWAY")),
              lines.rating_vs_line(lines.rating_diff(F.lit(82.0), F.lit(79.0), F.lit(1.0)), F.lit(-2.5)))
    assert tuple(row) == (4.0, -3.5, 3.5, 1.5)


def test_missing_rating_gives_no_edge(spark):
    df = spark.createDataFrame([(None, 80.0, 2.0, -3.0)], "home_pr double, away_pr double, hfa double, spread double")
    row = df.select(*[c.alias(n) for n, c in lines.edge_columns().items()]).first()
    assert row.rating_diff is None and row.rating_vs_odds_favored_team is None and row.favored_side == "HOME"


def test_edge_of_an_away_favourite(spark):
    df = spark.createDataFrame([(80.0, 90.0, 2.0, 6.5)], "home_pr double, away_pr double, hfa double, spread double")
    row = df.select(*[c.alias(n) for n, c in lines.edge_columns().items()]).first()
    # diff = 80 + 2 - 90 = -8; the away side is favoured by 6.5 and rated 8 better.
    assert row.asDict() == {"rating_diff": -8.0, "rating_vs_odds": -1.5, "favored_side": "AWAY", "spread_favored_team": -6.5,
                            "rating_diff_favored_team": 8.0, "rating_vs_odds_favored_team": 1.5}


def test_dense_rank_with_ties_and_nulls(spark):
    df = spark.createDataFrame([("A", 10.0), ("B", 10.0), ("C", 8.0), ("D", None)], "team string, v double").withColumn("s", F.lit(1))
    out = {r.team: r.v_rank for r in ranks.dense_rank_league(df, ["s"], {"v": True}).collect()}
    assert out == {"A": 1, "B": 1, "C": 2, "D": None}
    low = {r.team: r.v_rank for r in ranks.dense_rank_league(df, ["s"], {"v": False}).collect()}
    assert low == {"A": 2, "B": 2, "C": 1, "D": None}


def test_records(spark):
    df = spark.createDataFrame([(1, 21, 14, -3.0), (2, 10, 17, None), (3, 24, 24, None)],
                               "game_id int, pf int, pa int, line double").withColumn("season", F.lit(1))
    r = teams.season_records(df, ["season"]).select(lines.format_record("w", "l", "t", "su").alias("su")).first()
    assert r.su == "1-1-1"
    ats = spark.createDataFrame([(7, -3.0), (3, -3.0), (-4, 2.5)], "m int, line double")
    assert [x.o for x in ats.select(lines.ats_outcome("m", "line").alias("o")).collect()] == ["W", "P", "L"]


def test_record_styles(spark):
    row = one(spark, *[lines.format_record(F.lit(2), F.lit(1), F.lit(t), s)
                       for s in ("su", "ats", "ats_or_null", "ats_or_dash") for t in (0, 1)])
    assert tuple(row) == ("2-1", "2-1-1", "2-1-0", "2-1-1", "2-1-0", "2-1-1", "2-1", "2-1-1")
    none = one(spark, lines.format_record(F.lit(0), F.lit(0), F.lit(0), "ats_or_null"),
               lines.format_record(F.lit(0), F.lit(0), F.lit(0), "ats_or_dash"), lines.parse_record(F.lit("7-3-1"))["gp"],
               lines.parse_record(F.lit("n/a"))["gp"])
    assert tuple(none) == (None, "—", 11, None)


PRO_PAGE = "\n".join([
    " 1  Kansas City Chiefs        =  26.83    4   1   0   21.34(   7)   2  1  0 |   3  1  0 |   26.29    2  (AFC WEST)",
    " 12  NY Jets                   84.15    3   2   0   18.50(  27)   1  1  0 |   2  1  0 |   21.47   14  (AFC EAST)",
    " 27  Los Angeles Chargers*     =  20.79    3   2   0   20.93(  11)   2  1  0 |   2  1  0 |   20.66   15  (AFC WEST)",
    " 12  Somebody Else             70.00    3   2   0   18.50(  27)  (NFC EAST)",
    " 40  Too Low                   70.00    3   2   0   18.50(  27)  (NFC EAST)",
    " 13  No Conference             70.00    3   2   0   18.50(  27)"])


def test_pro_page_lines(spark):
    pages = spark.createDataFrame([("p", PRO_PAGE)], "page string, text string")
    rows = {r.team_raw: r for r in ratings.parse_rating_pages(pages, ["page"], style="pro", max_rank=32).collect()}
    got = {k: (r.pr_rank, r.pr, r.sos, r.sos_rank) for k, r in rows.items()}
    assert got == {"Kansas City Chiefs": (1, 26.83, 21.34, 7), "NY Jets": (12, 84.15, 18.50, 27),
                   "Los Angeles Chargers": (27, 20.79, 20.93, 11)}


def test_college_page_starts_after_header_and_first_line_wins(spark):
    text = "\n".join([
        "   1  Before Header        A  =  99.00    6   0   0   72.88(  17)", "COLLEGE FOOTBALL 2025 through - WEEK 7",
        "                HOME ADVANTAGE=[  4.63]   [  4.43]",
        "   1  Ohio State           A  =  95.97    6   0   0   72.88(  17)   1  0  0 |   3  0  0 |   92.83    1",
        "   2  Notre Dame           AA =  91.45    4   2   0   76.82(   5)", "(2) CONFERENCE AVERAGES",
        "   9  Ohio State           A  =  11.11    6   0   0   72.88(  17)"])
    pages = spark.createDataFrame([("p", text)], "page string, text string")
    rows = {r.team_raw: (r.pr_rank, r["class"], r.pr, r.sos, r.sos_rank) for r in ratings.parse_rating_pages(pages, ["page"]).collect()}
    assert rows == {"Ohio State": (1, "A", 95.97, 72.88, 17), "Notre Dame": (2, "AA", 91.45, 76.82, 5)}
    head = ratings.page_header(pages).first()
    assert (head.season, head.week, head.hfa, head.page_stamp) == (2025, 7, 4.63, "COLLEGE FOOTBALL 2025 through - WEEK 7")


def test_pro_names(spark):
    dim = entities.pro_alias_dim(spark)
    labels = ["LA Rams", "L.A. Rams", "NYJ", "ny jets", "New York", "Green Bay", "Niners", "la rams", "Nobody ", "N.Y.J",
              "st. louis", "Washington Football Team", "cardinals", "Los Angeles Rams"]
    df = spark.createDataFrame([(x,) for x in labels], "label string")
    got = {r.label: r.name for r in entities.resolve_entity(df, "label", dim, "name").collect()}
    assert got["LA Rams"] == got["L.A. Rams"] == got["la rams"] == got["st. louis"] == "Los Angeles Rams"
    assert got["NYJ"] == got["ny jets"] == "New York Jets"
    assert got["New York"] == "New York Giants" and got["Green Bay"] == "Green Bay Packers"
    assert got["Niners"] == "San Francisco 49ers" and got["Nobody "] == "Nobody" and got["N.Y.J"] == "N.Y.J"
    assert got["Washington Football Team"] == "Washington Commanders" and got["cardinals"] == "Arizona Cardinals"
    keys = {r.label: r.k for r in entities.merge_key(df, "label", dim, "k").collect()}
    assert keys["Los Angeles Rams"] == "losangelesrams" and keys["ny jets"] == "newyorkjets"


def test_college_names(spark):
    cases = {"Alabama Crimson Tide": "alabama", "Ohio State Buckeyes": "ohio state", "Brigham Young Cougars": "byu",
             "Duke Blue Devils": "duke", "Tigers": "tigers", "North Texas Mean Green": "north texas", "UMass": "massachusetts"}
    df = spark.createDataFrame(list(cases.items()), "label string, want string")
    for r in df.select("label", "want", entities.strip_suffix_words("label").alias("got")).collect():
        assert r.got == r.want, r.label
    row = one(spark, entities.normalize_label(F.lit(" usc ")), entities.normalize_label(F.lit("texas a&m")), entities.normalize_label(F.lit("")),
              entities.college_key(F.lit("Texas A&M")))
    assert tuple(row) == ("USC Trojans", "Texas Aandm", "", "texasaandm")


def test_numbers(spark):
    texts = ["1,234", "12-34", " 7.5 ", "-3", "-3-4", "n/a", "", "1d", "0x1p3", "NaN", "1e999", "1e3", ".5", "5."]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = {r.t: r.n for r in df.select("t", numbers.to_number("t").alias("n")).collect()}
    assert got == {"1,234": 1234.0, "12-34": 12.0, " 7.5 ": 7.5, "-3": -3.0, "-3-4": None, "n/a": None, "": None, "1d": None,
                   "0x1p3": None, "NaN": None, "1e999": None, "1e3": 1000.0, ".5": 0.5, "5.": 5.0}


def test_times_and_keys(spark):
    row = one(spark, times.parse_kickoff(F.lit(None), F.lit("2025-01-05"), F.lit("13:00")),
              times.parse_kickoff(F.lit(None), F.lit("2025-07-05"), F.lit("7:30 pm")),
              times.parse_kickoff(F.lit("2025-01-05T18:00:00+01:00"), F.lit("x"), F.lit("y")),
              times.parse_kickoff(F.lit(None), F.lit("2025-01-05"), F.lit(""), default_clock=None),
              times.parse_utc_or_epoch(F.lit("1736100000")), times.parse_utc_or_epoch(F.lit("soon")))
    shown = [v.strftime("%Y-%m-%d %H:%M") if v else None for v in row]
    assert shown[3] is None and shown[5] is None
    keys = spark.range(1).select(
        F.date_format(times.parse_kickoff(F.lit(None), F.lit("2025-01-05"), F.lit("13:00")), "HH:mm").alias("a"),
        F.date_format(times.parse_kickoff(F.lit(None), F.lit("2025-07-05"), F.lit("7:30 pm")), "HH:mm").alias("b"),
        names.game_key(F.lit("2025-10-18 16:00:00").cast("timestamp"), F.lit("Princeton!"), F.lit("Brown U.")).alias("k")).first()
    assert tuple(keys) == ("18:00", "23:30", "20251018_1600_princeton_brown_u")


def test_tuesday_start(spark):
    df = spark.createDataFrame([("2025-10-13 23:59:59",), ("2025-10-14 00:00:00",), ("2025-10-20 12:00:00",)], "t string")
    got = [r.s for r in df.select(F.date_format(times.tuesday_start(F.col("t").cast("timestamp")), "MM-dd").alias("s")).collect()]
    assert got == ["10-07", "10-14", "10-14"]


def test_decode_bytes(spark):
    df = spark.createDataFrame([(b"caf\xc3\xa9",), (b"caf\xe9 \x80\x92",), (b"\x81\xe9",)], "b binary")
    assert [r.t for r in df.select(ratings.decode_bytes("b").alias("t")).collect()] == ["café", "café €’", "\x81é"]


def test_strip_html(spark):
    df = spark.createDataFrame([("<pre>A&nbsp;&amp;B\r\n&lt;b&gt;x &eacute;&#8217;</pre>",), (None,)], "h string")
    # Decoding comes first, so an escaped tag is removed as well.
    assert [r.t for r in df.select(ratings.strip_html("h").alias("t")).collect()] == ["A &B\nx é’", None]


def test_html_table_column_choice(spark):
    def page(head, *rows):
        cells = "".join(f"<tr>{''.join(f'<td>{c}</td>' for c in r)}</tr>" for r in rows)
        return f"<table><tr>{''.join(f'<th>{h}</th>' for h in head)}</tr>{cells}</table>"
    pages = [("year", page(["Rank", "Team", "2023", "2024"], [1, "A*", 5, 6])), ("first", page(["Team", "Note", "Avg"], ["B+", "x", "1.5"])),
             ("skip", page(["Who", "2024"], ["A", 1]) + page(["Team", "2020"], ["C", 9])), ("none", "<p>no table</p>")]
    df = spark.createDataFrame(pages, "page string, html string")
    got = {(r.page, r.label, r.column, r.value) for r in nested.extract_html_tables(df, ["page"], "html").collect()}
    assert got == {("year", "A", "2024", 6.0), ("first", "B", "Avg", 1.5), ("skip", "C", "2020", 9.0)}
    wanted = nested.extract_html_tables(df.where("page = 'year'"), ["page"], "html", F.lit(2023)).first()
    assert (wanted.column, wanted.value) == ("2023", 5.0)


def test_pick_book(spark):
    df = spark.sql("""SELECT array(named_struct('key', 'a', 'title', 'A'), named_struct('key', 'PINNACLE', 'title', 'x')) AS b
                      UNION ALL SELECT array(named_struct('key', 'a', 'title', 'A')) UNION ALL SELECT array()""")
    assert [r.k for r in df.select(quotes.pick_book("b")["key"].alias("k")).collect()] == ["PINNACLE", "a", None]
