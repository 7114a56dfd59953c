"""Landed notice feeds, index pages and registry files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from . import canonical as C

RFC822 = "d MMM yyyy HH:mm:ss Z"


def feed_time(c: Column) -> Column:
    """Time of a feed item in its two usual forms."""
    plain = F.regexp_replace(F.regexp_replace(c, r"^[A-Za-z]{3},\s*", ""), r"(GMT|UTC|UT)$", "+0000")
    return F.coalesce(F.try_to_timestamp(plain, F.lit(RFC822)), F.try_to_timestamp(c))


def rss(spark: SparkSession, path: str) -> DataFrame:
    """Items of RSS and entries of Atom feeds: external_id, title, url, published_at, summary."""
    item = C.xml(spark, path, "item", "title string, link string, guid string, pubDate string, description string")
    entry = C.xml(spark, path, "entry", "title string, id string, link array<struct<_href:string>>, published string, updated string, summary string")
    a = item.select(F.coalesce(C.text(F.col("guid")), C.text(F.col("link"))).alias("external_id"), C.text(F.col("title")).alias("title"), C.text(F.col("link")).alias("url"), feed_time(F.col("pubDate")).alias("published_at"), C.text(F.col("description")).alias("summary"))
    href = F.get("link", F.lit(0))["_href"]
    b = entry.select(F.coalesce(C.text(F.col("id")), href).alias("external_id"), C.text(F.col("title")).alias("title"), href.alias("url"), feed_time(F.coalesce(C.text(F.col("published")), C.text(F.col("updated")))).alias("published_at"), C.text(F.col("summary")).alias("summary"))
    return a.unionByName(b).where("external_id IS NOT NULL")


def notice_pages(spark: SparkSession, path: str, ids: dict[str, str], keyword: str | None = None) -> DataFrame:
    """Pages of a notice interface (``results``): ids names the fields for external_id, title, url, published, text."""
    fields = ",".join(f"{c}:string" for c in dict.fromkeys(ids.values()))
    rows = spark.read.text(path, wholetext=True).select(F.explode(F.from_json("value", f"struct<results:array<struct<{fields}>>>")["results"]).alias("r"))
    out = rows.select(*[C.text(F.col(f"r.{c}")).alias(n) for n, c in ids.items()]).withColumn("published_on", F.to_date(F.substring("published", 1, 10))).drop("published")
    return out.where(F.lower(F.concat_ws(" ", "title", "text")).contains(keyword)) if keyword else out


def action_links(pages: DataFrame, html: str, asof_pattern: str = r"/recent-actions/(\d{8})(?:_\d+)?/?[\"']") -> DataFrame:
    """Dated action links of index pages."""
    hit = pages.select(F.explode(F.array_distinct(F.regexp_extract_all(html, F.lit(asof_pattern), F.lit(1)))).alias("external_id"))
    return hit.distinct().withColumn("published_on", F.try_to_date("external_id", "yyyyMMdd"))


def dated_blocks(pages: DataFrame, html: str, date_pattern: str = r"(\d{1,2} (?:January|February|March|April|May|June|July|August|September|October|November|December) \d{4})") -> DataFrame:
    """An update log cut at its dates: published_on, text and a stable id of each block."""
    marked = F.regexp_replace(T.html_to_text(F.col(html)), date_pattern, "\u0001$1\u0002")
    blocks = pages.select(F.explode(F.slice(F.split(marked, "\u0001"), 2, 1_000_000)).alias("b"))
    out = blocks.select(F.try_to_date(F.split("b", "\u0002")[0], "d MMMM yyyy").alias("published_on"), T.squeeze(F.split("b", "\u0002")[1]).alias("text"))
    return out.where("published_on IS NOT NULL").withColumn("external_id", F.concat(F.col("published_on").cast("string"), F.lit("-"), F.left(F.sha1(F.coalesce("text", F.lit(""))), F.lit(10))))


def registry_csv(spark: SparkSession, path: str) -> DataFrame:
    """Registry file with trimmed headers and cells; broken rows are kept as far as they go."""
    df = spark.read.option("header", "true").option("mode", "PERMISSIVE").option("enforceSchema", "false").csv(path)
    return df.select(*[C.text(F.col(f"`{c}`")).alias(c.strip()) for c in df.columns if c.strip()])


def curated_csv(spark: SparkSession, path: str, needs_imo: bool) -> DataFrame:
    """Curated entries of a review file with what is wrong with each row."""
    raw = registry_csv(spark, path)
    df = raw.select(*[F.col(f"`{c}`").alias(c.lower()) for c in raw.columns])
    for c in ("name", "imo", "flag", "country", "aliases"):
        if c not in df.columns:
            df = df.withColumn(c, F.lit(None).cast("string"))
    imo = T.extract_imo(F.col("imo"))
    checks = [("name is missing", F.col("name").isNull())]
    if needs_imo:
        checks += [("IMO is missing", imo.isNull()), ("IMO fails its check digit", imo.isNotNull() & ~T.imo_checksum_ok(imo))]
    problems = F.filter(F.array(*[F.when(c, F.lit(m)) for m, c in checks]), lambda x: x.isNotNull())
    return df.select("name", imo.alias("imo"), "flag", "country", C.texts(F.split("aliases", ";")).alias("aliases"), problems.alias("problems")).withColumn("ok", F.size("problems") == 0)


def curated_records(entries: DataFrame, iso: C.Iso, vessels: bool) -> DataFrame:
    """Active curated entries in key order as canonical records; the key is the ship number or the normalised name."""
    name = lambda v, t: C.fill(C.NAME, name_type=F.lit(t), full_name=v, quality=F.lit("STRONG"), parts=F.array())
    key = F.col("imo") if vessels else F.col("name_norm")
    ids = C.present(C.ident(F.lit("IMO number"), F.col("imo"), id_type="IMO")) if vessels else F.array().cast(f"array<{C.IDENT}>")
    listing = C.fill(C.LISTING, authority=F.lit("EU"), measures=F.array(F.lit("PORT_BAN" if vessels else "SECTORAL")))
    return C.canonical(
        entries.orderBy(key), source_key=key, entity_type=F.lit("VESSEL" if vessels else "ORGANIZATION"), names=F.concat(F.array(name(F.col("name"), "PRIMARY")), F.transform("aliases", lambda a: name(a, "AKA"))),
        identifiers=ids, listings=F.array(listing), vessel=C.fill(C.VESSEL, flag_raw=F.col("flag"), flag_iso2=iso(F.col("flag")), former_flags=F.array(), former_names=F.array()) if vessels else F.lit(None), extra=F.lit("{}"),
    )


def path_census(files: DataFrame, col: str, max_depth: int = 8) -> DataFrame:
    """(path, n): how often each element and attribute path occurs in XML texts, walked in Arrow batches."""
    import pandas as pd

    def walk(batches):
        from collections import Counter
        from xml.etree import ElementTree

        for pdf in batches:
            seen: Counter = Counter()
            for body in pdf[col].dropna():
                stack = [(ElementTree.fromstring(body), "", 1)]
                while stack:
                    el, at, depth = stack.pop()
                    here = f"{at}/{el.tag.rpartition('}')[2]}"
                    seen[here] += 1
                    for a in el.attrib:
                        seen[f"{here}/@{a.rpartition('}')[2]}"] += 1
                    if depth < max_depth:
                        stack += [(child, here, depth + 1) for child in el]
            yield pd.DataFrame({"path": list(seen), "n": list(seen.values())})

    return files.select(col).mapInPandas(walk, "path string, n long").groupBy("path").agg(F.sum("n").alias("n"))
