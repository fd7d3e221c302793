"""Raw shapes derived from the given tables by plain projections (see FIXTURES.md)."""

from pyspark.sql import functions as F

from quadrangle.functions.text import slug
from quadrangle.functions.urls import netloc
from quadrangle.session import scratch_path

DAY_ONE = "2024-06-01 08:30:00"
DAY_TWO = "2024-06-02 09:45:10.000250"


def instant(text=DAY_ONE):
    return F.to_timestamp(F.lit(text))


def table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _mod(column, n):
    return F.col(column) % n


def _author(key, name, places, faculty):
    key_text = F.col(key).cast("string")
    return places.select(
        F.concat(F.lit("A"), (F.col(key) % 1000).cast("string")).alias("id"),
        F.when(_mod(key, 17) != 0, F.col(name)).alias("display_name"),
        F.when(_mod(key, 3) == 0, F.concat(F.lit("0000-"), key_text)).alias("orcid"),
        _mod(key, 97).cast("bigint").alias("works_count"),
        _mod(key, 389).cast("bigint").alias("cited_by_count"),
        F.when(_mod(key, 11) == 0, F.array().cast("array<struct<display_name:string>>"))
        .otherwise(F.array(F.struct(F.col("n_name").alias("display_name"))))
        .alias("last_known_institutions"),
        F.col("r_name").alias("university"),
        faculty.alias("faculty"),
    )


def _with_region(people, nation_key, spark, sf_dir):
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    return people.join(nation, people[nation_key] == nation["n_nationkey"]).join(
        region, F.col("n_regionkey") == region["r_regionkey"]
    )


def authors(spark, sf_dir):
    """raw authors, several rows per id."""
    people = _with_region(table(spark, sf_dir, "customer"), "c_nationkey", spark, sf_dir)
    return _author("c_custkey", "c_name", people, F.col("c_mktsegment"))


SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


def later_authors(spark, sf_dir):
    """A second batch in F1 shape, with ids in common with the first."""
    people = _with_region(table(spark, sf_dir, "supplier"), "s_nationkey", spark, sf_dir)
    faculty = F.get(F.array(*[F.lit(s) for s in SEGMENTS]), (_mod("s_suppkey", 5)).cast("int"))
    return _author("s_suppkey", "s_name", people, faculty)


def _course_url():
    doc = F.col("doc_id").cast("string")
    shapes = [
        F.concat(F.lit("https://h/formation/Filiere_"), doc, F.lit(".pdf")),
        F.concat(F.lit("https://h/docs/Filières_"), doc, F.lit(".pdf")),
        F.concat(F.lit("https://h/cursus/"), doc, F.lit(".pdf")),
        F.concat(F.lit("https://h/docs/filiere_"), doc, F.lit(".pdf")),
        F.lit("https://h/programme.PDF"),
        F.concat(F.lit("https://h/programme.pdf?x="), doc),
        F.concat(F.lit("https://h/news/"), doc, F.lit(".pdf")),
    ]
    url = F.lit(None).cast("string")
    for remainder, shape in enumerate(shapes):
        url = F.when(_mod("doc_id", 8) == remainder, shape).otherwise(url)
    return url


def _course_metadata():
    """Source URL, a day of extraction that varies, and a stand-in for the checksum."""
    day = F.lpad((1 + _mod("doc_id", 28)).cast("string"), 2, "0")
    return F.struct(
        _course_url().alias("source_url"),
        F.concat(F.lit("2024-05-"), day).alias("extract_timestamp"),
        F.md5(F.col("doc_id").cast("string")).alias("content_checksum"),
    ).alias("metadata")


def course_payloads(spark, sf_dir):
    """extracted payloads of course and other documents."""
    return table(spark, sf_dir, "documents").select(
        _course_metadata(),
        "text",
        F.col("source").alias("university"),
        F.col("lang").alias("faculty"),
    )


def later_course_payloads(spark, sf_dir):
    """The labelled documents again, with their labels as text."""
    labelled = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id")
    return labelled.select(
        _course_metadata(),
        F.concat_ws(" ", F.lit("label"), F.col("quality").cast("string"), F.col("toxic").cast("string")).alias("text"),
        F.col("source").alias("university"),
        F.col("lang").alias("faculty"),
    )


def works(spark, sf_dir):
    """raw works."""
    key = F.col("o_orderkey").cast("string")
    return table(spark, sf_dir, "orders").select(
        F.concat(F.lit("https://h/W"), key).alias("id"),
        F.concat(F.lit("Work "), key).alias("display_name"),
        F.year("o_orderdate").alias("publication_year"),
        F.when(_mod("o_orderkey", 7) != 0, _mod("o_orderkey", 1000)).alias("cited_by_count"),
        F.col("o_orderpriority").alias("type"),
        F.when(_mod("o_orderkey", 4) != 0, F.concat(F.lit("10.1/"), key)).alias("doi"),
        F.when(
            _mod("o_orderkey", 5) != 0, F.struct((_mod("o_orderkey", 2) == 0).alias("is_oa"))
        ).alias("open_access"),
        F.col("o_orderstatus").alias("university"),
        F.concat(F.lit("F"), (_mod("o_custkey", 10)).cast("string")).alias("faculty"),
    )


ENDINGS = [
    ".pdf", ".PDF?x=1", ".jpg", ".webp", ".json", ".csv", ".docx", ".zip", ".css", ".woff2", ".html", "",
]


def crawled(spark, sf_dir):
    """crawled URLs with content, some of it empty."""
    ending = F.get(F.array(*[F.lit(e) for e in ENDINGS]), _mod("p_partkey", 12).cast("int"))
    return table(spark, sf_dir, "part").select(
        F.concat(F.lit("https://h/"), F.col("p_partkey").cast("string"), ending).alias("url"),
        F.col("p_brand").alias("university"),
        F.col("p_type").alias("faculty"),
        _mod("p_size", 4).alias("depth"),
        F.when(_mod("p_partkey", 25) == 0, "").otherwise(F.col("p_name")).alias("content"),
    )


def marked_pages(spark, sf_dir):
    """Pages, most of them with a marker of client-side rendering appended."""
    markers = [
        "callWS", "getTabs", "getPage", "angular", "react", "vue", "$(document).ready", "CALLWS", "",
    ]
    marker = F.get(F.array(*[F.lit(m) for m in markers]), _mod("page_id", 9).cast("int"))
    return table(spark, sf_dir, "pages").select("page_id", "url", F.concat("html", marker).alias("html"))


def linked_pages(spark, sf_dir):
    """pages with links of every kind appended to their own."""
    page = F.col("page_id").cast("string")
    extra = F.concat(
        F.lit('<a href="#a">a</a><a href="mailto:x@h">m</a><a href=\'javascript:v()\'>j</a>'),
        F.lit('<a href="tel:1">t</a><a name="n">n</a><a href="">e</a>'),
        F.lit('<a href="http://other.example.edu/p'), page, F.lit('">o</a>'),
        F.lit('<a href="http://cdn.example.edu/'), page, F.lit('.JPG?s=1">i</a>'),
        F.lit('<a title="up > one" href="../x'), page, F.lit('">u</a>'),
        F.lit('<a href="//'), netloc(F.col("url")), F.lit('/./y/../z">p</a>'),
        F.lit('<a href="?p=1&amp;q=2">q</a>'),
        F.lit('<a href=\'w#frag\'>f</a><a href="w#other">f</a>'),
        F.lit('<A CLASS="k" HREF=plain'), page, F.lit('>l</A>'),
        F.lit('<img alt="" src="/img/'), page, F.lit('.png#f"><img src="/s.js">'),
        F.lit('<!-- <a href="/hidden">h</a> --><script>"<a href=\'/code\'>"</script>'),
    )
    return table(spark, sf_dir, "pages").select("page_id", "url", F.concat("html", extra).alias("html"))


def _node(kind, key, ending=""):
    return F.concat(F.lit(f"https://h/{kind}/"), F.col(key).cast("string"), F.lit(ending))


def _customer_node(key):
    return F.when(_mod(key, 13) == 0, _node("customer", key, ".pdf")).otherwise(_node("customer", key))


def link_edges(spark, sf_dir):
    """region, nation, customer and order pages, linked both ways."""
    down = (
        table(spark, sf_dir, "nation").select(_node("region", "n_regionkey"), _node("nation", "n_nationkey"))
        .union(table(spark, sf_dir, "customer").select(_node("nation", "c_nationkey"), _customer_node("c_custkey")))
        .union(table(spark, sf_dir, "orders").select(_customer_node("o_custkey"), _node("order", "o_orderkey")))
        .toDF("src", "dst")
    )
    return down.union(down.select("dst", "src"))


def link_seeds(spark, sf_dir):
    return table(spark, sf_dir, "region").select(
        F.col("r_name").alias("university"), _node("region", "r_regionkey").alias("url")
    )


def web_pages(spark, sf_dir):
    """Pages that also link to two further pages of one site."""
    child = lambda n: (F.col("page_id") * 2 + n).cast("string")
    extra = F.concat(
        F.lit('<a href="/p/'), child(1), F.lit('.html">1</a><a href="./'), child(2), F.lit('.html#x">2</a>'),
        F.lit('<img src="/i/'), child(1), F.lit('.png"><a href="/d/'), child(2), F.lit('.css">s</a>'),
    )
    return table(spark, sf_dir, "pages").select(
        F.concat(F.lit("https://h/p/"), F.col("page_id").cast("string"), F.lit(".html")).alias("url"),
        F.concat("html", extra).alias("html"),
    )


def web_seeds(spark, sf_dir):
    return table(spark, sf_dir, "region").select(
        F.col("r_name").alias("university"),
        F.lit("web").alias("faculty"),
        F.concat(F.lit("https://h/p/"), F.col("r_regionkey").cast("string"), F.lit(".html")).alias("url"),
    )


def _object_path():
    ending = F.get(
        F.array(*[F.lit(e) for e in (".pdf", ".docx", ".doc", ".document")]), _mod("doc_id", 4).cast("int")
    )
    return F.concat(
        F.lit("university="), "source", F.lit("/faculty="), "lang", F.lit("/"),
        F.md5(F.col("doc_id").cast("string")), ending,
    )


def stored_documents(spark, sf_dir):
    """documents with text, some empty, some unreadable (NULL)."""
    text = F.when(_mod("doc_id", 9) == 0, "").when(_mod("doc_id", 25) != 0, F.col("text"))
    return table(spark, sf_dir, "documents").select(_object_path().alias("path"), text.alias("text"))


def document_sidecars(spark, sf_dir):
    """sidecars; every sixth lies under another name, so that its document has none."""
    lost = F.when(_mod("doc_id", 6) == 0, ".lost").otherwise("")
    return table(spark, sf_dir, "documents").select(
        F.concat(_object_path(), lost).alias("object_path"),
        F.concat(F.lit("https://h/doc/"), F.col("doc_id").cast("string")).alias("source_url"),
        F.col("source").alias("university"),
        F.col("lang").alias("faculty"),
        F.lit("2024-05-31T07:00:00").alias("crawl_timestamp"),
    )


def raw_bytes(spark, sf_dir):
    """F8: document bytes, every second one with invalid sequences put in."""
    damaged = F.concat(
        F.unhex(F.lit("FF")), F.encode("text", "UTF-8"), F.unhex(F.lit("E282")),
        F.encode(F.lit("é�"), "UTF-8"), F.unhex(F.lit("C0AF")), F.encode(F.lit("z"), "UTF-8"), F.unhex(F.lit("C3")),
    )
    return table(spark, sf_dir, "documents").select(
        "doc_id", F.when(_mod("doc_id", 2) == 0, damaged).otherwise(F.encode("text", "UTF-8")).alias("raw")
    )


def stored_universities(spark, sf_dir):
    """folders that exist, under varying names of a university."""
    people = _with_region(table(spark, sf_dir, "supplier"), "s_nationkey", spark, sf_dir)
    kind = _mod("n_nationkey", 5)
    name = (
        F.when(kind == 0, "hassan_2").when(kind == 1, "Hassan II").when(kind == 2, "Cadi Ayyad")
        .when(kind == 3, "kaddi_ayad").otherwise(F.replace(F.lower("r_name"), F.lit(" "), F.lit("_")))
    )
    return people.select(
        name.alias("university"), F.concat(F.lit("F"), _mod("s_suppkey", 40).cast("string")).alias("faculty")
    )


def requested_universities(spark, sf_dir):
    """hints asked for, some of them stored nowhere."""
    people = _with_region(table(spark, sf_dir, "customer"), "c_nationkey", spark, sf_dir)
    kind = _mod("c_custkey", 4)
    hint = (
        F.when(kind == 0, "hassan2").when(kind == 1, "cadi_ayyad").when(kind == 2, F.col("r_name")).otherwise("Nowhere")
    )
    return people.select(
        hint.alias("hint"), F.concat(F.lit("F"), _mod("c_custkey", 50).cast("string")).alias("faculty")
    )


def log_entries(spark, sf_dir):
    """Events as log entries."""
    level = F.when(F.col("event_type") == "error", "error").when(
        F.col("event_type") == "purchase", "warning"
    ).otherwise("info")
    return table(spark, sf_dir, "events").select(
        "ts",
        level.alias("level"),
        F.col("props").alias("message"),
        F.concat(F.lit("u"), _mod("user_id", 2).cast("string")).alias("university"),
        F.col("event_type").alias("faculty"),
        F.when(_mod("user_id", 7) != 0, F.concat(F.lit("from_"), "event_type")).alias("source"),
    )


def _html_object(pages, url):
    host = F.substring_index(netloc(F.col("url")), ".", -1)
    lang = F.regexp_extract("url", r"^[a-z]+://[^/]+/([a-z]+)/", 1)
    name = F.concat(
        F.lit("university="), host, F.lit("/faculty="), lang, F.lit("/year=2024/month=06/day=01/"),
        F.md5(url), F.lit(".html"),
    )
    return pages.select(host.alias("university"), lang.alias("faculty"), name.alias("object_name"), "html")


def html_objects(spark, sf_dir):
    """Stored HTML objects, filed under top-level domain and language."""
    return _html_object(table(spark, sf_dir, "pages"), F.col("url"))


def later_html_objects(spark, sf_dir):
    """A second crawl of all pages, changed; those with a fragment got a new name."""
    changed = table(spark, sf_dir, "pages").withColumn("html", F.concat(F.lit("<!-- v2 -->"), "html"))
    return _html_object(changed, F.substring_index("url", "#", 1))


OBJECTS_PER_FOLDER = 16


def site_objects(spark, sf_dir, day):
    """HTML objects of several pages each, as stored on one day; on the second day every
    third is stored again, changed."""
    blocks = table(spark, sf_dir, "pages").select("page_id", "url", "html", _mod("page_id", OBJECTS_PER_FOLDER).alias("block"))
    host = F.substring_index(netloc(F.col("url")), ".", -1)
    lang = F.regexp_extract("url", r"^[a-z]+://[^/]+/([a-z]+)/", 1)
    grouped = blocks.groupBy(host.alias("university"), lang.alias("faculty"), "block").agg(
        F.expr(r"listagg(html, '\n') WITHIN GROUP (ORDER BY page_id)").alias("html")
    )
    url = F.concat(F.lit("https://h/"), "university", F.lit("/"), "faculty", F.lit("/"), F.col("block").cast("string"))
    name = F.concat(
        F.lit("university="), "university", F.lit("/faculty="), "faculty", F.lit(f"/year=2024/month=06/day=0{day}/"),
        F.md5("url"), F.lit(".html"),
    )
    stored = grouped.withColumn("url", url).withColumn("object_name", name)
    if day == 2:
        stored = stored.where("block % 3 = 0").withColumn("html", F.concat(F.lit("<!-- v2 -->"), "html"))
    return stored


def site_sidecars(objects, day):
    """the sidecar of each object, as JSON; some have none."""
    quoted = lambda name, value: F.concat(F.lit(f'"{name}": "'), value, F.lit('"'))
    body = F.concat(
        F.lit("{\n "), quoted("source_url", F.col("url")), F.lit(", "), quoted("university", F.col("university")), F.lit(", "),
        quoted("faculty", F.col("faculty")), F.lit(',\n "depth_level": '), F.col("block").cast("string"),
        F.lit(f', "file_type": "html", "crawl_timestamp": "2024-06-0{day}T08:30:00", '),
        quoted("content_checksum", F.md5("html")), F.lit(", "), quoted("storage_path", F.concat(F.lit("s3://raw-web-html/"), "object_name")), F.lit("}"),
    )
    return objects.where("block % 3 <> 1 OR faculty <> 'es'").select(F.concat("object_name", F.lit(".meta.json")).alias("object_name"), body.alias("content"))


def put_objects(spark, objects, root):
    """Store each row of (object_name, content) as one object; its last byte is a line end."""
    staging = scratch_path(spark, "objects")
    objects.select(F.col("content").alias("value"), "object_name").repartition(16, "object_name").write.partitionBy("object_name").text(staging)
    jvm = spark._jvm
    new = jvm.org.apache.hadoop.fs.Path
    folder = new(staging)
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    plain = jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName
    for status in fs.listStatus(folder):
        name = status.getPath().getName()
        if not name.startswith("object_name="):
            continue
        target = new(f"{root}/{plain(name.split('=', 1)[1])}")
        fs.mkdirs(target.getParent())
        part = next(s.getPath() for s in fs.listStatus(status.getPath()) if s.getPath().getName().startswith("part-"))
        fs.rename(part, target)


def store_site(spark, sf_dir, root, day):
    """Put the objects of one day and their sidecars."""
    objects = site_objects(spark, sf_dir, day)
    put_objects(spark, objects.select("object_name", F.col("html").alias("content")), root)
    put_objects(spark, site_sidecars(objects, day), root)


def author_lines(spark, sf_dir):
    """authors as lines of JSON, some cut short, some no JSON, some with a word for a number."""
    people = _with_region(table(spark, sf_dir, "customer"), "c_nationkey", spark, sf_dir)
    key = F.col("c_custkey").cast("string")
    kind = _mod("c_custkey", 10)
    works = F.when(kind == 5, F.lit('"many"')).otherwise(_mod("c_custkey", 97).cast("string"))
    line = F.concat(F.lit('{"id":"A'), key, F.lit('","display_name":"'), "c_name", F.lit('","works_count":'), works, F.lit("}"))
    spoilt = F.when(kind == 3, F.substring(line, 1, 20)).when(kind == 7, F.concat(F.lit("not json "), key)).otherwise(line)
    return people.select(spoilt.alias("line"), slug(F.col("r_name")).alias("university"), F.col("c_mktsegment").alias("faculty"))


def store_author_lines(spark, sf_dir, root):
    """Put F15 below university, faculty, type, day and batch."""
    folders = {"type": "authors", "year": "2024", "month": "06", "day": "01", "batch": "b1"}
    rows = author_lines(spark, sf_dir).select(F.col("line").alias("value"), "university", "faculty", *[F.lit(v).alias(k) for k, v in folders.items()])
    rows.repartition("university", "faculty").write.partitionBy("university", "faculty", *folders).text(root)
