"""Job-market shaped inputs, derived from the test tables.

The test tables hold orders, documents and events instead of postings, so each
query runs on one of these views. Where a view stands for an older state of a
table, it is cut by date or by a business attribute; sources always are whole
tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from hirelake.session import broadcast_few

CUTOFF = "1998-05-01"
#: So many parts are broadcast (about 70 bytes each).
FEW_PARTS = 2_000_000


class Views:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def texts(self) -> DataFrame:
        return self.table("documents")

    # --- postings -----------------------------------------------------------

    def _lines(self) -> DataFrame:
        """Order lines with their order, part, supplier and place.

        The lines of an order end up side by side: parts that are few are broadcast, others are joined before the orders.
        """
        places = self.table("nation").join(
            self.table("region"), F.col("n_regionkey") == F.col("r_regionkey"))
        suppliers = self.table("supplier").join(places, F.col("s_nationkey") == F.col("n_nationkey"))
        orders = self.table("orders"), F.col("l_orderkey") == F.col("o_orderkey")
        parts, same_part = self.table("part"), F.col("l_partkey") == F.col("p_partkey")
        if parts.count() <= FEW_PARTS:
            lines = self.table("lineitem").join(*orders).join(F.broadcast(parts), same_part)
        else:
            lines = self.table("lineitem").join(parts, same_part).join(*orders)
        return lines.join(broadcast_few(suppliers), F.col("l_suppkey") == F.col("s_suppkey"))

    def staging_jobs(self) -> DataFrame:
        """One staged posting per order line; an order is a job posted several times."""
        created = (
            F.when(F.col("o_orderpriority") == "5-LOW", F.lit(0).cast("bigint"))
            .when(F.col("o_orderpriority") == "4-NOT SPECIFIED", F.lit(None))
            .otherwise(nanos("o_orderdate") + F.col("l_linenumber") * 137)
        )
        return self._lines().select(
            F.col("l_orderkey").cast("string").alias("job_id"),
            F.col("p_name").alias("title"),
            description().alias("description"),
            salary().alias("salary_min"),
            F.col("l_extendedprice").alias("salary_max"),
            created.alias("created"),
            link().alias("redirected_url"),
            F.date_format("l_shipdate", "yyyy-MM-dd'T'HH:mm:ss").alias("ingest_data"),
            nanos("l_shipdate").alias("ingest_ts"),
            company().alias("company_name"),
            F.col("p_type").alias("category_label"),
            city().alias("city"),
            F.col("r_name").alias("state"),
        )

    def raw_postings(self) -> DataFrame:
        """The same lines as nested postings, with the gaps real postings have."""
        kind = F.col("n_nationkey") % 5
        area = (
            F.when(kind == 1, F.array().cast("array<string>"))
            .when(kind == 2, F.array("r_name"))
            .when(kind == 3, F.array("r_name", "n_name"))
            .when(kind == 4, F.array("r_name", "n_name", "s_name", F.lit("deeper")))
        )
        created = (
            F.when(F.col("o_orderpriority") == "5-LOW", F.lit("soon"))
            .when(F.col("o_orderpriority") == "4-NOT SPECIFIED", F.lit(None))
            .when(F.col("o_orderpriority") == "3-MEDIUM", F.lit(""))
            .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd'T12:00:00Z'"))
        )
        name = F.when(F.col("s_acctbal") < 1000, F.lit("")).otherwise(F.col("s_name"))
        return self._lines().select(
            F.col("l_orderkey").cast("string").alias("id"),
            F.col("p_name").alias("title"),
            description().alias("description"),
            created.alias("created"),
            F.when(F.col("s_acctbal") <= 9000, F.struct(name.alias("display_name"))).alias("company"),
            F.struct(F.col("p_type").alias("label")).alias("category"),
            salary().alias("salary_min"),
            F.col("l_extendedprice").alias("salary_max"),
            link().alias("redirect_url"),
            F.col("l_returnflag").alias("contract_type"),
            F.col("l_linestatus").alias("contract_time"),
            F.struct(area.alias("area")).alias("location"),
        )

    def pages(self) -> DataFrame:
        """One JSON page per order: two postings, none, no array at all, or broken text."""
        def posting(suffix: str) -> Column:
            return F.struct(
                F.concat(F.col("o_orderkey").cast("string"), F.lit(suffix)).alias("id"),
                F.col("o_orderpriority").alias("title"),
                F.col("o_totalprice").alias("salary_max"),
            )

        page = F.to_json(F.struct(F.array(posting("a"), posting("b")).alias("results")))
        text = (
            F.when(F.col("o_orderpriority") == "5-LOW", F.lit('{"results": []}'))
            .when(F.col("o_orderpriority") == "4-NOT SPECIFIED", F.lit('{"count": 0}'))
            .when(F.col("o_orderpriority") == "3-MEDIUM", F.lit('{"results": [{"id": "x"'))
            .otherwise(page)
        )
        return self.table("orders").select(F.col("o_orderkey").alias("page_id"), text.alias("page"))

    # --- dimensions and targets --------------------------------------------

    def companies(self) -> DataFrame:
        return self.table("supplier").select(
            F.col("s_name").alias("company_name"), F.md5("s_name").alias("company_id"))

    def companies_known(self) -> DataFrame:
        return self.table("supplier").filter("s_acctbal >= 0").select(
            F.col("s_name").alias("company_name"),
            F.concat(F.lit("S"), F.col("s_suppkey").cast("string")).alias("company_id"))

    def categories(self) -> DataFrame:
        types = self.table("part").select(F.col("p_type").alias("category_label")).distinct()
        return types.withColumn("category_id", F.md5("category_label"))

    def categories_known(self) -> DataFrame:
        return self.categories().filter("category_label IN ('ECONOMY', 'PROMO')")

    def _customer_places(self) -> DataFrame:
        places = self.table("nation").join(
            self.table("region"), F.col("n_regionkey") == F.col("r_regionkey"))
        return self.table("customer").join(places, F.col("c_nationkey") == F.col("n_nationkey"))

    def locations_staging(self) -> DataFrame:
        """Place of every customer; the same city and state may lie in two countries."""
        return self._customer_places().select(
            city().alias("city"), F.col("r_name").alias("state"),
            F.when(F.col("c_acctbal") < 5000, "CA").otherwise("US").alias("country"))

    def locations(self) -> DataFrame:
        key = F.concat_ws("|", F.coalesce("city", F.lit("")), "state", "country")
        return self.locations_staging().distinct().withColumn("location_id", F.md5(key))

    def locations_known(self) -> DataFrame:
        """Two regions, with a blank city in the other spelling than in staging."""
        known = self._customer_places().filter("r_name IN ('AFRICA', 'ASIA') AND c_acctbal >= 5000")
        return known.select(
            F.when(F.col("n_nationkey") % 5 == 0, "").when(F.col("n_nationkey") % 5 == 1, None)
            .otherwise(F.col("n_name")).alias("city"),
            F.col("r_name").alias("state"), F.lit("US").alias("country"),
            F.concat(F.lit("N"), F.col("n_nationkey").cast("string")).alias("location_id")).distinct()

    def jobs_known(self) -> DataFrame:
        """Jobs table as it was at the cut-off date."""
        text = F.lit(None).cast("string")
        at = F.col("o_orderdate").cast("timestamp")
        return self.table("orders").filter(F.col("o_orderdate") < F.lit(CUTOFF)).select(
            F.col("o_orderkey").cast("string").alias("job_id"),
            F.col("o_orderpriority").alias("title"), text.alias("description"),
            F.lit(None).cast("double").alias("salary_min"), F.col("o_totalprice").alias("salary_max"),
            at.alias("created"),
            F.concat(F.lit("https://old.example/"), F.col("o_orderkey").cast("string"))
            .alias("redirected_url"),
            F.lit("snapshot").alias("ingest_data"), at.alias("ingest_ts"),
            text.alias("company_id"), text.alias("category_id"), text.alias("location_id"),
            F.lit("former").alias("company_name"), text.alias("category_label"),
            text.alias("city"), text.alias("state"),
        )

    def jobstats_staging(self) -> DataFrame:
        return self.table("lineitem").select(
            F.col("l_orderkey").cast("string").alias("job_id"),
            F.col("l_returnflag").alias("contract_type"), F.col("l_linestatus").alias("contract_time"),
            F.weekofyear("l_shipdate").cast("string").alias("posting_week"))

    def jobstats_known(self) -> DataFrame:
        return self.table("orders").filter(F.col("o_orderdate") < F.lit(CUTOFF)).select(
            F.col("o_orderkey").cast("string").alias("job_id"),
            F.col("o_orderstatus").alias("contract_type"), F.lit("old").alias("contract_time"),
            F.weekofyear("o_orderdate").cast("string").alias("posting_week"))

    def skill_catalogue(self, known: bool) -> DataFrame:
        """Parts as skills: the catalogue as known (cheap or small parts), or the new edition (large ones)."""
        part = self.table("part").filter("p_retailprice < 1500 OR p_size < 10" if known else "p_size >= 10")
        edition = F.lit("first" if known else "second")
        return part.select(
            F.col("p_partkey").cast("string").alias("skill_id"),
            F.concat_ws(" ", "p_name", edition).alias("skill_name"),
            edition.alias("skill_type"), F.col("p_type").alias("category"),
            F.col("p_brand").alias("subcategory"), F.lit(None).cast("string").alias("description"),
            F.concat_ws(",", "p_type", "p_brand").alias("tags"),
            (F.col("p_size") > 25).alias("is_soft_skill"),
            F.lit("https://skills.example").alias("info_url"),
            F.lit("2025-01-01 00:00:00").cast("timestamp").alias("ingest_ts"))

    # --- petitions and names ------------------------------------------------

    def petitions(self) -> DataFrame:
        """Order lines as petition rows; poor suppliers get approvals only from 2001 on."""
        year = F.year("l_shipdate")
        granted = (F.col("s_acctbal") > 2000) | (year > 2000)

        def counter(i: int, approval: bool) -> Column:
            units = (F.col("l_quantity").cast("int") + i * F.col("l_linenumber")) % (i + 2)
            units = F.nullif(units, F.lit(0))
            return F.when(granted, units) if approval else units

        kinds = ["new_employment", "new_concurrent", "change_of_employer",
                 "continuation", "change_with_same_employer", "amended"]
        counters = [
            counter(i, outcome == "approval").cast("int").alias(f"{kind}_{outcome}")
            for i, kind in enumerate(kinds) for outcome in ("approval", "denial")
        ]
        return (
            self.table("lineitem")
            .join(self.table("supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
            .select(
                year.alias("fiscal_year"), F.upper("s_name").alias("employer_petitioner_name"),
                F.col("l_returnflag").alias("industry_naics_code"),
                F.col("l_linestatus").alias("petitioner_city"), F.lit("MA").alias("petitioner_state"),
                (F.col("l_suppkey") * 7.0).alias("petitioner_zip_code"), "s_acctbal", *counters)
        )

    def company_names(self) -> DataFrame:
        """Customers as companies, written the way postings write them."""
        segment = F.col("c_mktsegment")
        name = (
            F.when(F.col("c_acctbal") < 0, F.lit("Services LLC"))
            .when(segment == "BUILDING", F.concat("c_name", F.lit(" LLC")))
            .when(segment == "AUTOMOBILE", F.concat("c_name", F.lit(", Inc.")))
            .when(segment == "MACHINERY", F.concat(F.lit("  "), "c_name", F.lit(" (formerly Old Co)")))
            .when(segment == "HOUSEHOLD", F.concat("c_name", F.lit(" Holdings   Group")))
            .otherwise(F.concat(F.lit("The "), "c_name", F.lit(" & Partners' Co.")))
        )
        return self.table("customer").select(
            F.col("c_custkey").cast("string").alias("company_id"), name.alias("company_name"))

    def sponsor_status(self) -> DataFrame:
        """Customers as employers, some under two official names."""
        upper = F.upper("c_name")
        names = F.when(
            F.col("c_acctbal") > 5000,
            F.array(F.concat(upper, F.lit(" CORPORATION")), F.concat(upper, F.lit(" LLC"))),
        ).when(F.col("c_acctbal") > 0, F.array(F.concat(F.lit("THE "), upper, F.lit(" CO"))))
        named = F.coalesce(names, F.array(F.concat_ws(" ", F.lit("GROUP, INC."), "c_mktsegment")))
        return self.table("customer").select(
            F.explode(named).alias("employer_name"), "c_nationkey", "c_acctbal"
        ).groupBy("employer_name").agg(
            F.bool_or(F.col("c_nationkey") < 15).alias("ever_sponsored_h1b"),
            F.max(F.lit(2000) + F.col("c_nationkey")).cast("int").alias("last_updated_fiscal_year"))

    # --- texts --------------------------------------------------------------

    def descriptions(self) -> DataFrame:
        """Documents as jobs; some mention years of experience."""
        years = (
            F.when(F.col("lang") == "en", " 5+ years ").when(F.col("lang") == "de", " 3-4 yrs")
            .otherwise("")
        )
        return self.texts().select(
            F.col("doc_id").cast("string").alias("job_id"),
            F.when(F.col("lang") != "de", F.col("source")).alias("title"),
            F.concat("text", years).alias("description"),
            F.when(F.col("lang") != "de", F.col("lang")).alias("category_label"),
            F.when(F.col("source") != "src3", F.col("source")).alias("company_name"),
            F.col("n_chars").alias("n_chars"))

    def documents(self) -> DataFrame:
        return self.texts().withColumn("job_id", F.col("doc_id").cast("string"))

    def experience_texts(self) -> DataFrame:
        kind = F.col("event_type")
        number = F.col("user_id").cast("string")
        text = (
            F.when(kind == "click", F.concat(F.lit("Needs "), number, F.lit(" Years of work")))
            .when(kind == "view", F.concat(number, F.lit("+ yrs, or 2 years")))
            .when(kind == "signup", F.concat(F.lit("min 5-"), number, F.lit(" years.")))
            .when(kind == "purchase", F.concat(number, F.lit(" - 7 year")))
            .otherwise(F.concat(number, F.lit("years")))
        )
        return self.table("events").select("event_id", text.alias("text"))

    def responses(self) -> DataFrame:
        """Events as enrichment responses: complete, with other types than asked for, with nulls, no object, broken."""
        k = F.get_json_object("props", "$.k")
        kind = F.col("event_type")
        full = F.concat(
            F.lit('{"skills": ["sql", "k'), k, F.lit('"], "years_min": '), k,
            F.lit(', "years_max": 99, "education": "BSc", "benefits": ["bonus"], "tech_stack": []}'))
        text = (
            F.when(kind == "click", full)
            .when(kind == "view", F.concat(
                F.lit('{"years_min": "'), k, F.lit('", "years_max": '), k, F.lit('.75, "skills": "sql", "benefits": {"a": 1}}')))
            .when(kind == "signup", F.lit('{"skills": null, "years_max": null, "benefits": ["a", "b"]}'))
            .when(kind == "purchase", F.concat(F.lit('[{"years_min": '), k, F.lit("}]")))
            .otherwise(F.concat(F.lit('{"years_min": '), k))
        )
        return self.table("events").select(
            F.col("event_id").cast("string").alias("job_id"), text.alias("response"))

    def vectors(self) -> DataFrame:
        return self.table("embeddings").select(
            "vec_id", F.col("embedding").cast("array<double>").alias("vector"),
            F.col("label").alias("cluster_id"))

    def members(self) -> DataFrame:
        """Documents as clustered jobs: cluster by length, id 9 empty; salaries partly unknown."""
        docs = self.texts().join(self.table("labels"), "doc_id", "left")
        return docs.select(
            F.col("doc_id").cast("string").alias("job_id"), "text",
            F.least(F.floor(F.col("n_chars") / 1000), F.lit(8)).cast("int").alias("cluster_id"),
            F.col("quality").cast("double").alias("salary_min"),
            F.col("n_chars").cast("double").alias("salary_max"))


def nanos(column: str) -> Column:
    return F.unix_micros(F.col(column).cast("timestamp")) * F.lit(1000).cast("bigint")


def description() -> Column:
    return F.concat_ws(" ", "p_name", "p_brand", "p_type")


def salary() -> Column:
    return F.col("l_extendedprice") * (1 - F.col("l_discount"))


def link() -> Column:
    parts = [F.col(c).cast("string") for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")]
    return F.concat_ws("/", F.lit("https://jobs.example"), *parts)


def company() -> Column:
    return F.when(F.col("s_acctbal") <= 9000, F.col("s_name"))


def city() -> Column:
    kind = F.col("n_nationkey") % 5
    return F.when(kind == 0, None).when(kind == 1, "").otherwise(F.col("n_name"))
