"""Articles from journal XML, exports, APIs and label tables, and dictionaries from thesauri."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from litloom.functions.text import article_link, find_year, similarity, squeeze
from litloom.storage import settle

# Names of tab-separated exports, and what we call them.
EXPORT_COLUMNS = {"TI": "title", "PY": "year", "SO": "journal", "AB": "abstract", "GA": "raw_affiliation", "DI": "url"}


def read_text_table(spark: SparkSession, path: str, sep: str = ",") -> DataFrame:
    """A CSV table as strings, read as UTF-8, or as ISO-8859-1 where that leaves undecodable characters; nulls are empty strings. An empty table is an error."""

    def read(encoding: str) -> DataFrame:
        return spark.read.csv(path, header=True, sep=sep, encoding=encoding, multiLine=True, escape='"').fillna("")

    rows = read("UTF-8")
    broken = F.lit(False)
    for c in rows.columns:
        broken = broken | F.contains(F.col(f"`{c}`"), F.lit("�"))
    if any("�" in c for c in rows.columns) or rows.where(broken).limit(1).count():
        rows = read("ISO-8859-1")
    if not rows.limit(1).count():
        raise ValueError(f"{path} has no rows")
    return rows


def read_exports(spark: SparkSession, path: str, dataset: str = "Science journals", encoding: str = "UTF-16") -> DataFrame:
    """Articles of tab-separated exports anywhere under a path, their columns renamed, years and links put right."""
    rows = spark.read.csv(path, header=True, sep="\t", encoding=encoding, recursiveFileLookup=True, pathGlobFilter="*.csv", multiLine=True, mode="DROPMALFORMED").fillna("")
    rows = rows.withColumnsRenamed(EXPORT_COLUMNS)
    have = lambda c: F.col(c) if c in rows.columns else F.lit("")
    doi = F.when(have("url").rlike("^https?://"), F.lit("")).otherwise(have("url"))
    empty = [F.lit("").alias(c) for c in ("keywords", "email", "identificators")]
    return rows.select(*[have(c).alias(c) for c in ("AU", "title")], find_year(have("year")).alias("year"), *[have(c).alias(c) for c in ("journal", "abstract")], article_link(have("url"), doi).alias("url"), have("raw_affiliation").alias("raw_affiliation"), *empty, F.lit(dataset).alias("dataset"))


JOURNAL_SCHEMA = """front struct<`journal-meta`: struct<`journal-title-group`: struct<`journal-title`: string>, publisher: struct<`publisher-name`: string, `publisher-loc`: string>>,
`article-meta`: struct<`article-id`: array<struct<`_VALUE`: string, `_pub-id-type`: string>>, `title-group`: struct<`article-title`: string>, abstract: struct<p: array<string>>,
`article-categories`: struct<`subj-group`: array<struct<`_subj-group-type`: string, subject: array<string>>>>, `kwd-group`: array<struct<kwd: array<string>>>, `pub-date`: array<struct<year: int>>,
`contrib-group`: array<struct<contrib: array<struct<`_contrib-type`: string, collab: string, email: array<string>, name: struct<surname: string, `given-names`: string>, aff: array<string>>>, aff: array<string>>>, aff: array<string>,
`author-notes`: struct<corresp: array<struct<email: array<string>>>>>>"""


def journal_article(front: Column) -> dict[str, Column]:
    """The parts of the front matter of an article, as columns; what is absent is empty."""
    meta, journal = front["article-meta"], front["journal-meta"]
    text = lambda c: F.coalesce(squeeze(c), F.lit(""))
    listed = lambda c: F.coalesce(F.filter(F.transform(c, squeeze), lambda x: x != ""), F.array().cast("array<string>"))
    people = F.flatten(F.transform(F.coalesce(meta["contrib-group"], F.array().cast(_kind("contrib-group"))), lambda g: F.coalesce(g["contrib"], F.array().cast(_kind("contrib")))))
    authors = F.filter(people, lambda p: F.coalesce(p["_contrib-type"], F.lit("author")) == "author")
    named = F.filter(authors, lambda p: p["name"].isNotNull())
    names = F.transform(named, lambda p: F.concat_ws(" ", p["name"]["surname"], p["name"]["given-names"]))
    mails = F.array_distinct(F.flatten(F.concat(F.transform(people, lambda p: listed(p["email"])), F.transform(F.coalesce(meta["author-notes"]["corresp"], F.array().cast("array<struct<email:array<string>>>")), lambda c: listed(c["email"])))))
    places = F.array_distinct(F.concat(F.flatten(F.transform(authors, lambda p: listed(p["aff"]))), F.flatten(F.transform(F.coalesce(meta["contrib-group"], F.array().cast(_kind("contrib-group"))), lambda g: listed(g["aff"]))), listed(meta["aff"])))
    groups = F.coalesce(meta["article-categories"]["subj-group"], F.array().cast("array<struct<`_subj-group-type`:string,subject:array<string>>>"))
    of_kind = lambda wanted: F.flatten(F.transform(F.filter(groups, lambda g: (F.coalesce(g["_subj-group-type"], F.lit("")) == "language") == wanted), lambda g: listed(g["subject"])))
    whole = F.array_join(listed(meta["abstract"]["p"]), " ")
    marked = r"(?s)^(.*?)\s*KEY ?WORDS?:\s*(.*)$"
    keywords = F.flatten(F.transform(F.coalesce(meta["kwd-group"], F.array().cast("array<struct<kwd:array<string>>>")), lambda g: listed(g["kwd"])))
    inline = F.filter(F.transform(F.split(F.regexp_extract(whole, marked, 2), "[;,]"), lambda k: F.trim(F.regexp_replace(k, r"\.$", ""))), lambda k: k != "")
    first_of = lambda kind: F.coalesce(F.get(F.transform(F.filter(meta["article-id"], lambda i: i["_pub-id-type"] == kind), lambda i: i["_VALUE"]), F.lit(0)), F.lit(""))
    return {
        "title": text(meta["title-group"]["article-title"]), "abstract": F.when(whole.rlike(marked), F.regexp_extract(whole, marked, 1)).otherwise(whole), "keywords": F.array_distinct(F.concat(keywords, inline)),
        "authors": names, "corporate_author": F.array_join(listed(F.transform(authors, lambda p: p["collab"])), "; "), "affiliation": places, "first_author_affiliation": F.coalesce(F.get(places, F.lit(0)), F.lit("")), "email": mails,
        "doi": first_of("doi"), "article_id": F.coalesce(F.get(F.transform(meta["article-id"], lambda i: i["_VALUE"]), F.lit(0)), F.lit("")), "subjects": of_kind(False), "language": F.array_join(of_kind(True), ";"),
        "journal": text(journal["journal-title-group"]["journal-title"]), "publisher": text(journal["publisher"]["publisher-name"]), "publisher_location": text(journal["publisher"]["publisher-loc"]), "year": F.array_min(F.transform(meta["pub-date"], lambda d: d["year"])),
    }


def _kind(part: str) -> str:
    contrib = "array<struct<`_contrib-type`:string,collab:string,email:array<string>,name:struct<surname:string,`given-names`:string>,aff:array<string>>>"
    return contrib if part == "contrib" else f"array<struct<contrib:{contrib},aff:array<string>>>"


def read_journal_xml(spark: SparkSession, path: str, row_tag: str = "article") -> DataFrame:
    """Articles of journal XML files under a path, with all that their front matter says."""
    rows = spark.read.format("xml").option("rowTag", row_tag).schema(JOURNAL_SCHEMA.replace("\n", " ")).load(path)
    return rows.select(*[c.alias(k) for k, c in journal_article(F.col("front")).items()])


API_SCHEMA = "title string, abstract string, year string, authors array<string>, keywords array<string>, doi string, url string"


def json_records(json: Column) -> Column:
    """The records of an API answer {"results": [...]}, an empty list where it is not one."""
    return F.coalesce(F.from_json(json, f"results array<struct<{API_SCHEMA.replace(' string', ':string').replace(' array', ':array')}>>")["results"], F.array().cast(f"array<struct<{API_SCHEMA.replace(' string', ':string').replace(' array', ':array')}>>"))


def api_articles(answers: DataFrame, json_col: str = "json") -> DataFrame:
    """Articles of API answers: title, abstract, year, AU, keywords, url; records without a title go."""
    r = answers.select(F.explode(json_records(F.col(json_col))).alias("r")).select("r.*").where("trim(coalesce(title, '')) <> ''")
    joined = lambda c: F.coalesce(F.array_join(c, ";"), F.lit(""))
    return r.select(F.trim("title").alias("title"), F.coalesce("abstract", F.lit("")).alias("abstract"), find_year(F.col("year")).alias("year"), joined("authors").alias("AU"), joined("keywords").alias("keywords"), article_link(F.coalesce("url", F.lit("")), F.col("doi")).alias("url"))


def split_affiliated_authors(raw: Column) -> Column:
    """Array of (author, affiliation) from "Name (place); Name (place)"; without brackets the affiliation is empty."""
    parts = F.filter(F.transform(F.split(raw, r";(?![^(]*\))"), lambda p: F.trim(p)), lambda p: p != "")
    rule = r"^([^(]*)\((.*)\)\s*$"
    return F.transform(parts, lambda p: F.struct(F.trim(F.when(p.rlike(rule), F.regexp_extract(p, rule, 1)).otherwise(p)).alias("author"), F.trim(F.regexp_extract(p, rule, 2)).alias("affiliation")))


def label_rows(html: Column) -> Column:
    """Array of (label, value) of a page's two-cell table rows, tags removed and labels without a colon."""
    rule = r"(?is)<tr[^>]*>\s*<t[hd][^>]*>(.*?)</t[hd]>\s*<td[^>]*>(.*?)</td>\s*</tr>"
    plain = lambda c: squeeze(F.regexp_replace(c, "<[^>]*>", " "))
    labels, cells = (F.regexp_extract_all(html, F.lit(rule), F.lit(g)) for g in (1, 2))
    return F.zip_with(labels, cells, lambda a, b: F.struct(F.regexp_replace(plain(a), r"\s*:$", "").alias("label"), plain(b).alias("value")))


def label_table(pages: DataFrame, columns: dict[str, str], id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """One row for each page with a label table: the values of the labels in `columns` (label to name), several joined by semicolons."""
    rows = pages.select(F.col(id_col).alias("id"), F.posexplode(label_rows(F.col(html_col))).alias("at", "r")).select("id", "at", "r.*")
    of = lambda label: F.array_join(F.transform(F.array_sort(F.collect_list(F.when(F.lower("label") == label.lower(), F.struct("at", "value")))), lambda s: s["value"]), ";")
    return rows.groupBy("id").agg(*[of(label).alias(name) for label, name in columns.items()])


def fresh_records(found: DataFrame, seen: DataFrame, key: str) -> DataFrame:
    """Records of the pages of a crawl (page, place, ...) that were not seen before, each once, where it came first."""
    new = found.join(seen.select(key).distinct(), key, "left_anti")
    return new.withColumn("__nth", F.row_number().over(Window.partitionBy(key).orderBy("page", "place"))).where("__nth = 1").drop("__nth")


def place_dictionary(shapes: DataFrame) -> DataFrame:
    """Columns name, kind, country of subdivisions (country, province, district) whose name belongs to one country only."""
    of = lambda kind: shapes.select(F.trim(kind).alias("name"), F.lit(kind).alias("kind"), "country")
    rows = of("province").unionByName(of("district")).where("name <> ''").distinct()
    return rows.join(rows.groupBy("name").agg(F.count_distinct("country").alias("countries")).where("countries = 1").select("name"), "name", "left_semi")


def enrich_places(places: DataFrame, subdivisions: DataFrame, least: float = 0.7) -> DataFrame:
    """Columns country, name, known: each official subdivision (country, name) with the most similar place of its country above `least`."""
    x, y = subdivisions.select("country", "name"), places.select("country", F.col("name").alias("known"))
    alike = similarity(F.lower("name"), F.lower("known"))
    near = x.join(y, "country").withColumn("s", alike).where(F.col("s") > least)
    best = near.groupBy("country", "name").agg(F.min_by("known", F.struct((-F.col("s")).alias("s"), "known")).alias("known"))
    return x.join(best, ["country", "name"], "left")


def merge_products(products: DataFrame, jaccard: float = 0.5, edits: float = 0.8) -> DataFrame:
    """Columns name, product: names that share half of their words or are close in edits, as connected groups named by the first by letters.

    Names meet that share a word or their first three letters.
    """
    words = lambda c: F.filter(F.split(squeeze(F.lower(c)), " "), lambda w: w != "")
    rows = products.select("name").distinct().select("name", words(F.col("name")).alias("w"))
    keys = rows.select("name", "w", F.explode(F.array_distinct(F.concat("w", F.array(F.concat(F.lit("^"), F.substr(F.lower("name"), F.lit(1), F.lit(3))))))).alias("key"))
    x, y = keys.alias("x"), keys.alias("y")
    shared = F.size(F.array_intersect("x.w", "y.w")) / F.size(F.array_union("x.w", "y.w"))
    pairs = x.join(y, (F.col("x.key") == F.col("y.key")) & (F.col("x.name") < F.col("y.name")) & ((shared >= jaccard) | (similarity(F.lower("x.name"), F.lower("y.name")) >= edits)))
    pairs = settle(pairs.select(F.col("x.name").alias("a"), F.col("y.name").alias("b")).distinct())
    both = settle(pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"))))
    labels = settle(rows.select("name", F.col("name").alias("product")))
    while True:
        near = both.join(labels.select(F.col("name").alias("b"), "product"), "b").groupBy(F.col("a").alias("name")).agg(F.min("product").alias("near"))
        step = settle(labels.join(near, "name", "left").select("name", F.least("product", "near").alias("product"), F.coalesce(F.col("near") < F.col("product"), F.lit(False)).alias("changed")))
        labels = step.select("name", "product")
        if not step.where("changed").limit(1).count():
            return labels


def flatten_paths(paths: DataFrame) -> DataFrame:
    """Columns narrow, broad, level_3, top from (path: names from the root down, between slashes): the last four names, the last repeated where there are fewer."""
    names = F.filter(F.transform(F.split("path", "/"), lambda p: F.trim(p)), lambda p: p != "")
    up = F.reverse(names)
    padded = F.concat(F.array_repeat(F.get(up, F.lit(0)), F.greatest(4 - F.size(up), F.lit(0))), up)
    rows = paths.select(padded.alias("p")).where(F.get("p", F.lit(0)).isNotNull())
    return rows.select(*[F.get("p", F.lit(i)).alias(c) for i, c in enumerate(("narrow", "broad", "level_3", "top"))]).distinct()


def filter_words(tables: DataFrame, columns: list[str]) -> DataFrame:
    """Columns word: all words and phrases of the columns, as they are (lower case) and in the normal form of index terms."""
    from litloom.functions.text import normalize_text, tokens

    cells = tables.select(F.explode(F.array(*columns)).alias("cell")).where("trim(coalesce(cell, '')) <> ''")
    forms = F.array(F.lower(F.trim("cell")), F.array_join(tokens(normalize_text(F.col("cell"))), " "))
    return cells.select(F.explode(forms).alias("word")).where("word <> ''").distinct()


def rank_dictionary(rows: DataFrame) -> DataFrame:
    """Columns word, rank (the least), kinds (sorted) from (word, rank, kind)."""
    return rows.groupBy(F.lower(F.trim("word")).alias("word")).agg(F.min("rank").alias("rank"), F.array_sort(F.collect_set("kind")).alias("kinds"))
