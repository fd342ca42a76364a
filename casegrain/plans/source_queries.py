"""Sources and sinks over the domain tables: what is written in a foreign form comes back as it was."""

from __future__ import annotations

import io
import tarfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from casegrain.functions.keys import article_of_path, clean_href
from casegrain.operators import merge
from casegrain.plans.dataset_queries import latest, latest_sql
from casegrain.plans.registry import Registry
from casegrain.session import table, temporary_root
from casegrain.sources import artifacts, files, jats

R = Registry()

LIVE_CASES = latest_sql("cases", "patient_uid")
LIVE_IMAGES = latest_sql("images", "image_path")
FORMS = ["whole", "no_link", "other_record", "malformed", "host", "two_links"]


@R.query("q_package_links", f"""WITH a AS (SELECT pmc_id, count(*) AS n, max(length(coalesce(title, ''))) AS k FROM {LIVE_CASES} GROUP BY 1), b AS (SELECT 'PMC' || pmc_id AS pmc_id, {FORMS!r}[k % {len(FORMS)} + 1] AS form FROM a)
    SELECT pmc_id, CASE form WHEN 'no_link' THEN 'no_link' WHEN 'other_record' THEN 'no_record' WHEN 'malformed' THEN 'malformed' WHEN 'host' THEN 'host' WHEN 'two_links' THEN 'several_links' END AS problem,
      CASE WHEN form = 'whole' THEN 'https://packages.example/oa/' || pmc_id || '.tar.gz' END AS download_url, CASE WHEN form = 'whole' THEN pmc_id || '.tar.gz' END AS archive_name FROM b""")
def q_package_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metadata responses written for every article in six forms, five of them faulty, and read for their archive link."""
    a = latest(spark, sf_dir, "cases", "patient_uid").groupBy("pmc_id").agg(F.max(F.length(F.coalesce("title", F.lit("")))).alias("k"))
    form = F.element_at(F.array(*[F.lit(f) for f in FORMS]), F.col("k") % len(FORMS) + 1)
    pmc = F.concat(F.lit("PMC"), "pmc_id")
    link = lambda host, kind, end: F.concat(F.lit(f'<link format="{kind}" href="https://{host}/oa/'), pmc, F.lit(f'{end}"/>'))
    good, pdf = link("packages.example", "tgz", ".tar.gz"), link("packages.example", "pdf", ".pdf")
    inner = F.when(form == "no_link", pdf).when(form == "host", link("elsewhere.example", "tgz", ".tar.gz")).when(form == "two_links", F.concat(good, link("packages.example", "tgz", ".v2.tar.gz"))).otherwise(F.concat(pdf, good))
    own = F.when(form == "other_record", F.concat(pmc, F.lit("9"))).otherwise(pmc)
    xml = F.concat(F.lit('<OA><records><record id="'), own, F.lit('">'), inner, F.lit("</record></records>"), F.when(form == "malformed", "").otherwise("</OA>"))
    return files.read_packages(a.select(pmc.alias("pmc_id"), xml.cast("binary").alias("content")), ("packages.example",)).select("pmc_id", "problem", "download_url", "archive_name")


def _tars(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        rows = []
        for archive, paths in zip(b["archive"], b["paths"], strict=True):
            out = io.BytesIO()
            with tarfile.open(fileobj=out, mode="w:gz") as tar:
                for name in [*paths, "notes.txt", "../escape.jpg", "/root.jpg", f"{archive}/article.nxml"]:
                    data = name.encode()
                    info = tarfile.TarInfo(name)
                    info.size = len(data)
                    tar.addfile(info, io.BytesIO(data))
            rows.append((archive, out.getvalue()))
        yield pd.DataFrame(rows, columns=["archive", "content"])


@R.query("q_archive_members", f"""WITH m AS (SELECT pmc_id AS archive, image_path AS member FROM {LIVE_IMAGES} UNION ALL SELECT DISTINCT pmc_id, pmc_id || '/article.nxml' FROM {LIVE_IMAGES})
    SELECT archive, member, CAST(strlen(member) AS BIGINT) AS size, sha256(member) AS digest FROM m""")
def q_archive_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archives made for every article, with unsafe and unwanted members, and read member by member."""
    i = latest(spark, sf_dir, "images", "image_path").groupBy(F.col("pmc_id").alias("archive")).agg(F.sort_array(F.collect_list("image_path")).alias("paths"))
    made = i.mapInPandas(_tars, "archive string, content binary")
    return files.archive_members(made).select("archive", "member", "size", F.sha2("content", 256).alias("digest"))


@R.query("q_figure_members", f"""WITH x AS (SELECT pmc_id AS archive, image_path, regexp_extract(image_path, '([^/]+)\\.jpg$', 1) AS stem FROM {LIVE_IMAGES})
    SELECT archive, stem AS figure, image_path AS member, CAST(CASE WHEN length(stem) % 3 = 0 THEN 0 WHEN length(stem) % 3 = 1 THEN 1 ELSE 2 END AS INT) AS rank FROM x""")
def q_figure_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Figure references in three spellings (relative to the article, without suffix, as the whole path) and the members they mean."""
    i = latest(spark, sf_dir, "images", "image_path").select(F.col("pmc_id").alias("archive"), "image_path", F.regexp_extract("image_path", r"([^/]+)\.jpg$", 1).alias("stem"), F.regexp_extract("image_path", r"^(.*/)", 1).alias("home"))
    form = F.length("stem") % 3
    said = F.when(form == 0, F.concat(F.lit("./"), "stem", F.lit(".jpg?full#page"))).when(form == 1, F.replace("stem", F.lit("_"), F.lit("%5F"))).otherwise(F.col("image_path"))
    hrefs = i.select("archive", F.col("stem").alias("figure"), F.lit(0).alias("ordinal"), clean_href(said).alias("href"), F.when(form == 2, "").otherwise(F.col("home")).alias("folder"))
    return merge.first_resolved(merge.resolve_members(hrefs, i.select("archive", F.col("image_path").alias("member")))).select("archive", "figure", "member", "rank")


@R.query("q_path_articles", "SELECT DISTINCT image_path, pmc_id AS article FROM images WHERE image_path IS NOT NULL")
def q_path_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The article of each image, taken from its path."""
    return table(spark, sf_dir, "images").where("image_path IS NOT NULL").select("image_path", article_of_path(F.col("image_path")).alias("article")).distinct()


@R.query("q_json_lines", f"SELECT patient_uid, pmc_id, title, case_description, population_scope.label AS label FROM {LIVE_CASES}")
def q_json_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Live cases written as canonical JSON lines, published, and read with a closed schema."""
    live = latest(spark, sf_dir, "cases", "patient_uid").select("patient_uid", "pmc_id", "title", "case_description", "population_scope")
    path = f"{temporary_root(spark, 'lines')}/cases"
    artifacts.write_json_lines(live, path, ["patient_uid"])
    schema = T.StructType([live.schema[c] for c in sorted(live.columns)])
    return files.read_json_lines(spark, path, schema).select("patient_uid", "pmc_id", "title", "case_description", F.col("population_scope.label").alias("label"))


@R.query("q_canonical_rows", """SELECT sha256('{"anatomy":' || coalesce(CAST(to_json(anatomy) AS VARCHAR), 'null') || ',"pair_id":' || coalesce(CAST(to_json(pair_id) AS VARCHAR), 'null') || ',"record_index":' || record_index || '}') AS digest, count(*) AS n FROM pair_descriptions GROUP BY 1""")
def q_canonical_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of rows as canonical JSON: keys in order, nulls written, no blanks."""
    d = table(spark, sf_dir, "pair_descriptions").select("record_index", "pair_id", "anatomy")
    return d.select(F.sha2(artifacts.canonical_rows(d), 256).alias("digest")).groupBy("digest").agg(F.count(F.lit(1)).alias("n"))


def _tag(name: str, c) -> F.Column:
    text = F.replace(F.replace(F.coalesce(c, F.lit("")), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))
    return F.concat(F.lit(f"<{name}>"), text, F.lit(f"</{name}>"))


def collapsed_sql(c: str) -> str:
    return f"trim(regexp_replace(coalesce({c}, ''), '[\\s\\p{{Z}}]+', ' ', 'g'))"


@R.query("q_jats_figures", f"""WITH c AS (SELECT DISTINCT patient_uid, caption_id, coalesce(caption, '') AS caption, coalesce(image_path, '') AS image_path FROM captions)
    SELECT patient_uid, CAST(row_number() OVER (PARTITION BY patient_uid ORDER BY caption_id, caption, image_path) AS INT) AS number, {collapsed_sql('caption')} AS caption, image_path AS href FROM c""")
def q_jats_figures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Articles with one figure per caption record, read back: running number, caption and the reference to its image."""
    c = table(spark, sf_dir, "captions").select("patient_uid", "caption_id", F.coalesce("caption", F.lit("")).alias("caption"), F.coalesce("image_path", F.lit("")).alias("image_path")).distinct()
    fig = lambda f: F.concat(F.lit("<fig><caption>"), _tag("p", f["caption"]), F.lit('</caption><graphic xlink:href="'), F.replace(f["image_path"], F.lit("&"), F.lit("&amp;")), F.lit('"/></fig>'))
    g = c.groupBy("patient_uid").agg(F.array_sort(F.collect_list(F.struct("caption_id", "caption", "image_path"))).alias("fs"))
    xml = F.concat(F.lit('<article xmlns:xlink="http://www.w3.org/1999/xlink"><front/><body>'), F.array_join(F.transform("fs", fig), ""), F.lit("</body></article>"))
    files_made = g.select("patient_uid", xml.alias("content"))
    figures = jats.read_articles(files_made, "patient_uid", "content").select("patient_uid", F.explode("figures").alias("f"))
    return figures.select("patient_uid", "f.number", "f.caption", F.coalesce(F.get("f.hrefs", F.lit(0)), F.lit("")).alias("href"))


@R.query("q_jats_metadata", f"SELECT patient_uid, {collapsed_sql('title')} AS title, {collapsed_sql('case_description')} AS abstract, {collapsed_sql('journal_title')} AS journal, '10.5555/' || patient_uid AS doi FROM {LIVE_CASES}")
def q_jats_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Title, abstract, journal and identifier of every live case, through an article and back."""
    live = latest(spark, sf_dir, "cases", "patient_uid")
    front = F.concat(
        F.lit("<article><front><journal-meta>"), _tag("journal-title", F.col("journal_title")), F.lit('</journal-meta><article-meta><article-id pub-id-type="doi">10.5555/'), "patient_uid", F.lit("</article-id><title-group>"), _tag("article-title", F.col("title")),
        F.lit("</title-group><abstract>"), _tag("p", F.col("case_description")), F.lit("</abstract></article-meta></front><body/></article>"),
    )
    return jats.read_articles(live.select("patient_uid", front.alias("content")), "patient_uid", "content").select("patient_uid", "title", "abstract", "journal", "doi")
