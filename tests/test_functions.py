"""Table-driven checks of the column functions: one frame and one collect per function."""

from datetime import date, datetime

from pyspark.sql import functions as F

from kalends.functions import dates, regions, text, urls


def run(spark, function, cases):
    df = spark.createDataFrame([(i, c[0]) for i, c in enumerate(cases)], "i int, x string").select("i", function(F.col("x")).alias("y"))
    got = {r["i"]: r["y"] for r in df.collect()}
    for i, (x, want) in enumerate(cases):
        assert got[i] == want, (x, got[i], want)


def test_titles(spark):
    run(spark, text.clean_title, [("Story Time | Site", "Story Time"), ("  Big   Show. ", "Big Show"), ("Page Not Found", None), ("", None), (None, None), ("Farm – apples, plums, pears", "Farm"), ("Center – Explore. Create", "Center"), ("Museum of Washington DC", "Museum")])
    run(spark, text.title_case, [("FAMILY STORY TIME at the library", "Family Story Time at the Library"), ("the end", "The End"), ("mrs.b reads", "Mrs. B Reads"), (None, None)])


def test_summaries(spark):
    run(spark, text.clean_summary, [("[vc_row a=1]A long enough summary &amp; more[/vc_row]", "A long enough summary & more"), ("too short", None), ("Fairfax County, Virginia.", None), ("Visit our wonderful shop in town today", None), ("<p>Music &#8211; for all the family</p>", "Music – for all the family"), (None, None), ("An unclosed shortcode [vc_column width", "An unclosed shortcode")])


def test_places(spark):
    want = lambda n, a, ci, co: {"location_name": n, "location_address": a, "city": ci, "county": co}
    cases = [
        ("Main Library, 501 Elm St, Reston, VA 20190", want("Main Library", "501 Elm St, Reston, VA 20190", "Reston", "Fairfax")),
        ("Farm Farm Get Directions now", want("Farm", None, None, None)),
        ("Book Shop Address20427 Exchange StAshburn", want("Book Shop", "20427 Exchange St, Ashburn", "Ashburn", "Loudoun")),
        ("Hall • Sterling, VA", want("Hall", None, "Sterling", "Loudoun")),
        (None, want(None, None, None, None)),
    ]
    df = spark.createDataFrame([(i, c[0]) for i, c in enumerate(cases)], "i int, x string").select("i", text.location(F.col("x")).alias("y"))
    for r in df.collect():
        got = r["y"].asDict() if r["y"] else want(None, None, None, None)
        assert got == cases[r["i"]][1], (cases[r["i"]][0], got)


def test_prices_and_sentences(spark):
    run(spark, text.price_text, [("  $5   each ", "$5 each"), ("", None), (None, None), ("x" * 300, "x" * 200)])
    run(spark, text.salvaged_price, [("word " * 60 + "Registration fee: $20. more", "Registration fee: $20"), ("word " * 60, None), ("$5", "$5")])
    run(spark, text.several_sentences, [("One. Two", True), ("Dr. Smith reads.", False), ("J. Doe and St. Mary.", False), ("Just one.", False), (None, False), ("", False)])
    run(spark, text.machine_name, [("Ashburnice", True), ("Airandspace.Si", True), ("Short", False), ("Two Words", False), (None, False)])


def test_urls(spark):
    run(spark, urls.host, [("https://www.Wolftrap.org/x", "wolftrap.org"), ("ftp//x", None), (None, None), ("http://a.b:80?q", "a.b:80")])
    run(spark, urls.valid_url, [("https://a.b", True), ("a.b", False), (None, False), ("", False)])
    run(spark, urls.original_host, [("https://ok.org/1", True), ("https://m.facebook.com/1", False), (f"https://{urls.AGGREGATOR}/x", False), ("/rel", False), (None, False)])
    run(spark, urls.shortener, [("https://bit.ly/x", True), ("https://www.bit.ly/x", True), ("https://rabbit.ly/x", False)])
    run(spark, urls.site_name, [("https://www.my-site.org/1", "My Site")])


def test_dates(spark):
    parse = lambda c: dates.parse_datetime(c, 2024)
    run(spark, parse, [
        ("2024-03-01 10:30:00", datetime(2024, 3, 1, 10, 30)), ("Saturday, Mar 2, 9:30AM", datetime(2024, 3, 2, 9, 30)), ("Mar 2 2024 at 7:00 pm", datetime(2024, 3, 2, 19, 0)), ("2024-03-01T10:00:00-05:00", datetime(2024, 3, 1, 15, 0)),
        ("2020-02-29", datetime(2024, 2, 29)), ("soon", None), ("", None), (None, None), ("May 5", datetime(2024, 5, 5)),
    ])
    run(spark, dates.schedule_time, [("9:30", "09:30:00"), ("2:05 pm", "14:05:00"), ("9 AM", "09:00:00"), ("noon", None), (None, None)])
    run(spark, dates.schedule_date, [("2024-01-05", date(2024, 1, 5)), ("2024-01-05T10:00", date(2024, 1, 5)), ("x", None)])


def test_spelled_dates(spark):
    """Spellings that no fixed format fits, with readings written by hand."""
    day, seven = datetime(2024, 3, 5), datetime(2024, 3, 5, 19)
    run(spark, lambda c: dates.parse_datetime(c, 2024), [
        ("March 5th, 2024 7pm", seven), ("5 March 2024 19:00", seven), ("Tuesday, March 5 7 PM", seven), ("Tue 5 Mar 2024, 7:00 p.m.", seven), ("7pm on March 5, 2024", seven), ("5th of March 2024 at 7 PM", seven),
        ("Doors open March 5 @ 7:00 PM", seven), ("2024/03/05 19:00", seven), ("3/5/24 7:00 PM", seven), ("3-5-2024 7pm", seven), ("3.5.2024 19:00", seven), ("5-Mar-2024 19:00:00", seven), ("Mar. 5, '24, 7 PM", seven), ("3/5 7pm", seven),
        ("2024 March 5 7pm", seven), ("20240305T190000", seven), ("20240305T1900", seven), ("MARCH 5 2024 07:00PM EST", seven), ("2024-03-05 7:00 pm", seven), ("7:00PM Tuesday March 5th", seven), ("Mar 5, 2024 19:00 -0500", datetime(2024, 3, 6)), ("March 5 2024 7pm+02:00", datetime(2024, 3, 5, 17)),
        ("2024-01-01T01:00:00+02:00", datetime(2023, 12, 31, 23)), ("2020-06-01T22:00:00-04:00", datetime(2024, 6, 2, 2)), ("2023-02-29T10:00:00Z", None), ("Jan 1, 2024 1 am +0200", datetime(2023, 12, 31, 23)),
        ("20240305", day), ("5 Mar", day), ("March 5th", day), ("Sept 3rd", datetime(2024, 9, 3)), ("the 1st of May", datetime(2024, 5, 1)), ("13/4/2024", datetime(2024, 4, 13)), ("12 am March 5 2024", day), ("12:15 a.m., March 5", datetime(2024, 3, 5, 0, 15)), ("March 5, 2024 12pm", datetime(2024, 3, 5, 12)),
        ("Dec 31 1999 11:59 pm", datetime(2024, 12, 31, 23, 59)), ("March 5, 2031 7pm", datetime(2031, 3, 5, 19)), ("Feb 29th, 2023", None), ("February 29th, 2020", datetime(2024, 2, 29)), ("2024/03/05 10:20:30.5", datetime(2024, 3, 5, 10, 20, 30, 500000)),
        ("March 5, 2024 7 PM - 9 PM", None), ("March 5, 2024 7pm-9pm", None), ("March 5, 2024, Room 12", None), ("March 2024", None), ("Saturday 7pm", None), ("marching band", None), ("Feb 30th", None), ("13/45/2024", None), ("March 5 25:00", None), ("TBD", None), ("|||", None), ("5", None),
    ])


def test_area_bounds(spark):
    df = spark.createDataFrame([(38.3, -78.6), (39.6, -76.3), (38.29, -77.0), (None, -77.0)], "a double, b double").select(regions.in_area(F.col("a"), F.col("b")).alias("x"))
    assert [r["x"] for r in df.collect()] == [True, True, False, False]
