"""Fixed word lists and texts. Callers can pass their own in their place."""

# Search terms whose result pages are collected.
SEARCH_TERMS = [
    "Big Data Engineer",
    "Data Engineer",
    "Data Platform Engineer",
    "ETL Developer",
    "Data Pipeline Developer",
    "Data Infrastructure Engineer",
    "Data Integration Engineer",
    "DataOps Engineer",
]

# A role is kept when at least two of its words are in this list.
# Entries with a space can never equal a single word; they are kept as given.
ROLE_KEYWORDS = [
    "Big", "Data", "Engineer", "Cloud", "Integration", "ETL", "Infrastructure", "Pipeline",
    "DataOps", "Developer", "Platform", "Warehouse", "Airflow", "Spark", "Kafka", "Hadoop",
    "Databricks", "Snowflake", "Redshift", "BigQuery", "Fivetran", "dbt", "PostgreSQL", "MySQL",
    "SQL", "NoSQL", "DeltaLake", "ML Engineer", "ETL Developer", "Data Architect",
    "Analytics Engineer", "Platform Engineer", "BI Engineer", "Data Specialist", "Data Manager",
    "AWS", "GCP", "Azure", "Streaming", "Batch", "Lakehouse", "Data Lake", "Data Warehouse",
    "Ingestion", "Transformation", "Data Modeling", "Data Governance", "Orchestration",
    "Web Scraping", "Scraper", "Extraction", "Collection", "Web Crawler", "Architect",
]

# Words left out of the word-frequency table
# (English, Bahasa Indonesia, job-posting filler, stray numbers).
STOP_WORDS = """
the and or to in of a an is it for on with
this that at as by are be you we from was will
have has can if your our they he she their them
but about more other may not which who what how do
dan yang dengan dalam untuk atau pada dari sebagai
job role description requirement requirements responsibilities
position candidate candidates opportunity team teams client
clients responsibility communication skills skill tools tool
knowledge year years experience experiences understanding
familiarity strong good great minimum preferred plus
working work ability ensure related such build develop
development projects project engineering engineer bachelor
degree excellent background including preferred detail
science computer management information field level provide
must should across also etc new join within using help
teams per needed pengalaman seperti anda kualifikasi lainnya
1 2 3 4 5 12 90 58 56 54 52 51 49 46 43 41 39 38 37
us any its youll please product company service
helping apply closely make create develop needed
jakarta indonesia team teams based join support
help looking ensure able must should well part
success value perform responsible provide deliver
""".split()

# Texts put in place of missing or composite fields.
NO_COMPANY = "Advertiser didn't show the company"
NO_WORK_TYPE = "The Advertiser did not show the work type"
CONTRACT_WORK_TYPE = "Kontrak/Temporer"

# Time rendering and the time given to a posting without one.
TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
NO_TIME = "1900-01-01 00:00:00"

# Fixed value: rows of the word-frequency table.
TOP_WORDS = 300
