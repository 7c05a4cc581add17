from pyspark.sql import functions as F

from hirelake.functions.markup import inner_html, visible_text
from hirelake.operators.pages import attach_details, extract_cards, extract_details, matching_roles
from hirelake.plans.daily import collect_pages
from hirelake.sources.raw import read_raw

CARDS = (
    '<div data-search-sol-meta="1"><article data-job-id="111"><a data-automation="jobTitle" href="/j">'
    'Data <b>Engineer</b></a><a data-automation="jobCompany">PT A &amp;amp; B</a>'
    '<div>nested</div><span data-automation="jobListingDate"><i>3h</i> ago</span></article></div>'
    '<a data-automation="jobLocation">outside</a>'
    '<div data-search-sol-meta="2"><article data-job-id="222"><a data-automation="jobTitle">ETL Dev</a></article></div>'
    '<div data-search-sol-meta="3"><article data-job-id="333"></article></div>'
    '<div data-search-sol-meta="4"><a data-automation="jobTitle">no id</a></div>'
)
DETAIL = (
    '<div data-automation="jobAdDetails"><div><p>One</p><ul><li>two  x</li><li>R&amp;D</li></ul></div>'
    '<!-- <p>no</p> --><script>"</div>"</script>last<br>line</div><div>outside</div>'
    '<div data-automation="jobAdDetails">more</div>'
    '<span data-automation="job-detail-work-type"><a>Full</a>, <a>Part</a></span>'
    '<span data-automation="job-detail-salary">Rp&nbsp;5</span>'
)


def pages(spark, *rows):
    df = spark.createDataFrame(list(rows), "page_id long, url string, html string, keyword string")
    return df.withColumn("scraped_at", F.lit("2025-07-18 12:00:00").cast("timestamp_ntz"))


def test_elements(spark):
    html = '<span a="x"><span>1</span> b</SPAN>z<span a="x"></span>t<span a=x><spanner>k</spanner>'
    df = spark.createDataFrame([(html,)], "h string")
    got = df.select(inner_html(F.col("h"), "span", "a", "x")).first()[0]
    assert got == ["<span>1</span> b", "", "<spanner>k</spanner>"]


def test_visible_text(spark):
    texts = {
        "a<br>b": "a\nb",
        "a <b> b</b> c": "a b c",
        "<p>x<br></p><p>y</p>": "x\ny",
        "a\n <i>b</i>\n\n c": "a b c",
        "&lt;b&gt; &amp;lt; &#8364;&#x20AC;&nbsp;&eacute; &bogus; &": "<b> &lt; €€ é &bogus; &",
        "<style>p{}</style>t": "t",
        "x < y > z": "x < y > z",
        "&#xD800;": "�",
        "": "",
        None: None,
    }
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, h string")
    got = [r[0] for r in df.orderBy("i").select(visible_text(F.col("h"))).collect()]
    assert got == list(texts.values())


def test_cards(spark):
    got = extract_cards(pages(spark, (1, "s", CARDS, "k")), "https://e/", "sg", keep=["keyword"]).collect()
    assert [tuple(r) for r in got] == [
        (1, 0, "k", "111", "Data Engineer", "PT A &amp; B", None, "2025-07-18 09:00:00", "https://e/111", "sg"),
        (1, 1, "k", "222", "ETL Dev", None, None, "2025-07-18 12:00:00", "https://e/222", "sg"),
    ]


def test_page_without_cards(spark):
    assert extract_cards(pages(spark, (1, "s", "<p>none</p>", "k"), (2, "s", None, "k")), "", "sg").count() == 0


def test_details(spark):
    got = extract_details(pages(spark, (1, "u", DETAIL, None), (2, "v", "<p>404</p>", None))).orderBy("page_id").collect()
    assert [tuple(r) for r in got] == [
        (1, "u", "One; two x; R&D; last; line more", "Rp 5", "Full; Part"),
        (2, "v", "", "", ""),
    ]


def test_attach_keeps_every_card_once(spark):
    cards = spark.createDataFrame([("u", 1), ("u", 2), ("w", 3)], "URL string, n int")
    details = spark.createDataFrame(
        [(2, "u", "late", "", ""), (1, "u", "early", "5", "t")],
        "page_id long, URL string, job_desc string, salary string, work_type string",
    )
    got = sorted(tuple(r) for r in attach_details(cards, details).select("n", "job_desc", "salary").collect())
    assert got == [(1, "early", "5"), (2, "early", "5"), (3, "", "")]


def test_role_filter(spark):
    cards = extract_cards(pages(spark, (1, "s", CARDS, "k")), "", "sg")
    assert [r.Role for r in matching_roles(cards).collect()] == ["Data Engineer"]


def test_collect_pages(spark, tmp_path):
    folder = str(tmp_path / "Source_Data_Board_sg")
    search = pages(spark, (1, "s", CARDS, "Data Engineer"))
    detail = pages(spark, (2, "https://e/111", DETAIL, None))
    args = (search, detail, folder, "board", "https://e/", "sg")
    collect_pages(*args, "20250718_120000", mark="2025-07-18 08:59:59")
    collect_pages(*args, "20250719_120000", mark="2025-07-18 09:00:00")  # nothing newer
    for fmt in ("csv", "json"):
        rows = read_raw(spark, folder, fmt).collect()
        assert [(r.Job_ID, r.salary, r.source, str(r.table_date)) for r in rows] == [
            ("111", "Rp 5", "board_sg", "2025-07-18")
        ]
    runs = [p.name for p in (tmp_path / "Source_Data_Board_sg").iterdir() if p.is_dir()]
    assert runs == ["run=board_DataEngineer_sg_20250718_120000"]
