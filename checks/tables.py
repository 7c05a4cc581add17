"""Test tables, and postings and pages derived from them."""

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame, *keys: str, rows_per_task: int = 250_000) -> DataFrame:
    """Narrow rows dealt out by ``keys`` before they are widened. A file of some
    megabytes may hold millions of rows: one task's wide copies of them would not fit
    its memory. The count comes from the files' footers; a few rows stay as they are."""
    n_tasks = -(-df.count() // rows_per_task)
    return df.repartition(n_tasks, *keys) if n_tasks > 1 else df


def tables(spark: SparkSession, sf_dir: str, *names: str) -> dict[str, DataFrame]:
    return {n: table(spark, sf_dir, n) for n in names}


# Dialect differences between Spark SQL and DuckDB, filled into the templates.
SPARK = {"S": "STRING", "T": "date_format(l_shipdate, 'yyyy-MM-dd HH:mm:ss')"}
DUCK = {"S": "VARCHAR", "T": "strftime(l_shipdate, '%Y-%m-%d %H:%M:%S')"}

LINE_COLUMNS = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_shipdate")

# Messy raw postings: repeated ids, missing fields, stray case and spaces, line
# breaks, salary texts of several kinds. `source` and `day` spread them over two
# sources and two days.
POSTINGS = r"""
SELECT CASE WHEN l_linenumber = 7 AND l_partkey % 50 = 0 THEN NULL
            WHEN l_linenumber = 6 AND l_partkey % 40 = 0 THEN concat(' ', CAST(l_orderkey AS {S}))
            ELSE CAST(l_orderkey AS {S}) END AS Job_ID,
  CASE l_partkey % 5 WHEN 0 THEN concat('  data engineer ', p_name)
    WHEN 1 THEN 'Senior DATA ENGINEER' WHEN 2 THEN 'DATA ENGINEERING Lead'
    WHEN 3 THEN concat(p_name, ' Pipeline Developer ')
    ELSE concat('Cloud ', p_type, ' Engineer') END AS Role,
  CASE WHEN l_suppkey % 17 = 0 THEN NULL ELSE s_name END AS Company,
  concat('City ', CAST(s_nationkey AS {S})) AS Location,
  CASE WHEN l_suppkey % 23 = 0 THEN NULL ELSE {T} END AS Publish_Time,
  concat('https://example.com/job/', CAST(l_orderkey AS {S}), '/',
    CAST(l_linenumber AS {S}), '/', CAST(l_partkey AS {S}), '/',
    CAST(l_suppkey AS {S})) AS URL,
  'indonesia' AS country,
  CASE WHEN l_partkey % 19 = 0 THEN NULL
    ELSE concat('Build ', p_name, ' flows; must know: ', p_type, ',', chr(10), p_brand, ' (',
      CAST(l_suppkey AS {S}), ') "and" the SQL of ', s_name) END AS job_desc,
  CASE l_quantity % 4
    WHEN 0 THEN concat('Rp ', CAST(l_partkey AS {S}), ',000,000 – Rp ',
                       CAST(l_partkey + l_suppkey AS {S}), ',000,000 per month')
    WHEN 1 THEN concat('$', CAST(l_partkey AS {S}), ' - $', CAST(l_partkey + 9 AS {S}))
    WHEN 2 THEN concat('Rp ', CAST(l_partkey AS {S}), '.000.000')
    ELSE NULL END AS salary,
  CASE l_suppkey % 4 WHEN 0 THEN 'Kontrak/Temporer; Full time' WHEN 1 THEN ''
    WHEN 2 THEN NULL ELSE ' Full time ' END AS work_type,
  CASE WHEN l_suppkey % 2 = 0 THEN 'board_north' ELSE 'board_south' END AS source,
  CASE WHEN l_partkey % 2 = 0 THEN '2025-07-18' ELSE '2025-07-19' END AS day
FROM {lineitem} JOIN {part} ON p_partkey = l_partkey JOIN {supplier} ON s_suppkey = l_suppkey
"""


def postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All postings with ``source`` and ``day``."""
    t = tables(spark, sf_dir, "lineitem", "part", "supplier")
    # by part, where a join with many parts looks for them
    t["lineitem"] = spread(t["lineitem"].select(*LINE_COLUMNS), "l_partkey")
    names = {n: f"{{{n}}}" for n in t}
    return spark.sql(POSTINGS.format(**SPARK, **names), **t)


def postings_sql() -> str:
    return POSTINGS.format(**DUCK, lineitem="lineitem", part="part", supplier="supplier")


# One search page per order. First card: inner tags, entities, nested spans.
# Second: no company, no location, no age. Third: no job id. Fourth: no title.
SEARCH_PAGES = r"""
SELECT o_orderkey AS page_id, 'https://example.com/search' AS url,
  CASE o_orderkey % 4 WHEN 0 THEN 'Data Engineer' WHEN 1 THEN 'ETL Developer'
    WHEN 2 THEN 'Big Data Engineer' ELSE 'Chef' END AS keyword, o_orderdate AS scraped_at,
  concat('<html><body><nav><a href="/">Home</a></nav>',
   '<div data-search-sol-meta="1" class="c"><article data-job-id="', o_orderkey, '">',
   '<div><a title="a > b" data-automation=jobTitle href="/j">Data &amp; <b>Engineer</b>\n ', o_orderpriority, '</a></div>',
   '<a data-automation="jobCompany">PT &#65;', o_custkey, '</a><a class=x data-automation="jobLocation"> City<br>', o_orderstatus, '</a>',
   '<span data-automation="jobListingDate"><span>', o_orderkey % 50,
   CASE o_orderkey % 3 WHEN 0 THEN 'm' WHEN 1 THEN 'h' ELSE 'd' END, '</span> ago</span></article></div>',
   '<div data-search-sol-meta="2"><article data-job-id=', o_orderkey, 'x><a data-automation="jobTitle">',
   CASE WHEN o_orderkey % 5 = 0 THEN 'Office Manager ' ELSE 'ETL Developer ' END, o_orderstatus, '</a></article></div>',
   '<div data-search-sol-meta="3"><a data-automation="jobTitle">No id</a></div>',
   '<div data-search-sol-meta="4"><article data-job-id="9"><a href="/">No title</a></article></div><footer>end</footer></body></html>') AS html
FROM {orders}
"""

# The detail page of the first card of each search page.
DETAIL_PAGES = r"""
SELECT o_orderkey AS page_id, concat('https://example.com/job/', o_orderkey) AS url,
  concat('<html><head><style>p {{ margin: 0 }}</style></head><body><div class="top">skip</div>',
   '<div class="d" data-automation="jobAdDetails"><div><p>Needs <b>SQL</b></p><ul><li>status ', o_orderstatus,
   '</li><li>R&amp;D</li></ul></div><script>var a = "<p>";</script><p>Call ', o_custkey, '</p></div><div>skip</div>',
   CASE WHEN o_orderkey % 2 = 0 THEN '<div data-automation="jobAdDetails">more</div>' ELSE '' END,
   '<span data-automation="job-detail-work-type"><span><a href="/f">Full time</a>, <a>Kontrak</a></span></span>',
   CASE WHEN o_orderkey % 3 = 0 THEN concat('<span data-automation="job-detail-salary">Rp&nbsp;', o_custkey, '</span>') ELSE '' END,
   '</body></html>') AS html
FROM {orders}
"""


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority")
    return spread(table(spark, sf_dir, "orders").select(*columns), "o_orderkey")


def search_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(SEARCH_PAGES, orders=_orders(spark, sf_dir))


def detail_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(DETAIL_PAGES, orders=_orders(spark, sf_dir))
