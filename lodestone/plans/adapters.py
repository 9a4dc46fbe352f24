"""Person records made from the driver's tables, so that the operators have something to work on at any scale."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.sources.resumes import resume_records
from lodestone.sources.tables import structured_records

SKILL_LISTS = ["python, SQL , aws", "Java,Spring Boot,microservices", "  scala,spark ,Hadoop,", "nodejs, react,REDUX, Node.js", "Excel, power bi,tableau", "c++,C#,go , rust", "", "sklearn, scikit learn, NLP,pytorch, TensorFlow"]
PLACES = ["Springfield, {n}", "{n}", "Port {n} ,  East ,{n}", "springfield,  {n}"]


def _table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*columns)


def recruiter_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One recruiter row per order: the customer is the person, and e-mail, phone or both are missing in some rows."""
    orders = _table(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderpriority")
    # Narrow rows are dealt over the cores before records are made of them: a small file is one task, though its records take long.
    orders = orders.repartition(4 * spark.sparkContext.defaultParallelism, "o_orderkey")
    customers = _table(spark, sf_dir, "customer", "c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    nations = _table(spark, sf_dir, "nation", "n_nationkey", "n_name")
    key, cust = F.col("o_orderkey"), F.col("o_custkey")
    digits = F.lpad(cust.cast("string"), 8, "0")
    a, b = F.substring(digits, 1, 4), F.substring(digits, 5, 4)
    number = (
        F.when(key % 11 < 3, F.concat(F.lit("+44 (20) "), a, F.lit("-"), b))
        .when(key % 11 < 6, F.concat(F.lit("004420"), a, b))
        .when(key % 11 < 9, F.concat(F.lit("44 20 "), a, F.lit("."), b))
        .otherwise(F.concat(F.lit(" +4420"), digits))
    )
    pick = lambda items, at: F.element_at(F.array(*map(F.lit, items)), (at + 1).cast("int"))
    place = F.replace(pick(PLACES, key % 4), F.lit("{n}"), F.col("n_name"))
    return (
        orders.join(customers, cust == F.col("c_custkey"))
        .join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            key.alias("seq"),
            F.when(key % 7 == 0, "resume_docx").when(key % 7 == 1, "resume_pdf").otherwise("recruiter_csv").alias("source_type"),
            F.replace(F.lower("c_name"), F.lit("#"), F.lit(" ")).alias("name"),
            F.when(key % 3 != 0, F.concat(F.when(key % 2 == 0, "Person.").otherwise("person."), cust.cast("string"), F.lit("@Example.com"))).alias("email"),
            F.when(key % 5 > 1, number).alias("phone"),
            F.when(key % 13 != 0, F.col("c_mktsegment")).alias("company"),
            F.when(key % 17 != 0, F.col("o_orderpriority")).alias("title"),
            pick(SKILL_LISTS, key % 8).alias("skills"),
            F.when(key % 19 != 0, place).alias("location"),
        )
    )


def structured(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw records of the orders; all are structured, whatever their source type, which decides their priority."""
    return structured_records(recruiter_rows(spark, sf_dir), "orders")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw records of the documents' texts."""
    docs = _table(spark, sf_dir, "documents", "doc_id", "text").filter("text is not null")
    name = F.concat(F.lit("doc"), F.col("doc_id").cast("string"), F.lit(".docx"))
    made = resume_records(docs.select(F.lit(None).cast("string").alias("file_path"), name.alias("file_name"), F.lit("docx").alias("suffix"), F.col("text").alias("raw_text"), F.lit(None).cast("string").alias("checksum_sha256"), "doc_id"))
    return made.withColumn("seq", F.regexp_extract("file_name", r"(\d+)", 1).cast("long"))
