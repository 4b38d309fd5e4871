"""Document scans and header ("front matter") parsing.

A document is Markdown text that may start with a ``---`` delimited header of
``key: value`` lines.  Parsing is pure Column expressions; the header map is
built without ``map_from_entries`` duplicate errors by keeping only the last
entry per key (the reader's "last duplicate wins").
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from recflow.functions import vocab
from recflow.functions.projections import title_unquote
from recflow.functions.text import LINE_BREAK, WS, col, py_strip

HEADER_RE = r"(?s)\A---\n(.*?)\n---\n"
# Python whitespace without the newline: stays on one line.
WS_NO_NL = WS[:-1] + r"&&[^\n]]"


def file_systems():
    """What finds the pyarrow file system of a URI (local, HDFS, object store) and the path
    in it; a function made here goes to the tasks whole, which can't import this module."""
    def file_system(uri: str):
        from pyarrow import fs as pafs
        if uri.startswith("file:") and not uri.startswith("file://"):
            uri = "file://" + uri[len("file:"):]
        return pafs.FileSystem.from_uri(uri)

    return file_system


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


#: Files go on from a reading task once they hold this many bytes together.
READ_BYTES = 8 << 20


def list_files(spark: SparkSession, folders: list[str], ending: str = ".md") -> DataFrame:
    """(bucket, file_name, path) of the files below the folders, listed in the tasks, a folder each.

    As in Spark's own listing, empty files and what lies under names that begin with
    '_' or '.' are left out (the folders themselves may begin so), and file_name and
    bucket, the name of the folder that a file lies in, are spelled as in its URI."""
    import pandas as pd
    file_system = file_systems()

    def run(batches):
        from urllib.parse import quote

        from pyarrow import fs as pafs

        def spelled(name):
            return "".join(c if ord(c) > 127 else quote(c, safe="!'()*:@&=+$,;") for c in name)

        for pdf in batches:
            for folder in pdf["folder"]:
                filesystem, base = file_system(folder)
                infos = filesystem.get_file_info(pafs.FileSelector(base, recursive=True))
                base = base.rstrip("/")
                found = (i for i in infos if i.type == pafs.FileType.File and i.size and i.base_name.endswith(ending))
                rows = []
                for i in found:
                    inner = i.path[len(base) + 1:].split("/")
                    if any(n.startswith(".") or n.endswith("._COPYING_") or n.startswith("_") and "=" not in n for n in inner):
                        continue
                    rows.append((spelled(i.path.rsplit("/", 2)[-2]), spelled(i.base_name), i.path))
                    if len(rows) == 10_000:
                        yield pd.DataFrame(rows, columns=["bucket", "file_name", "path"])
                        rows = []
                yield pd.DataFrame(rows, columns=["bucket", "file_name", "path"], dtype=object)

    n = len(folders)
    tasks = spark.range(0, n, 1, n).select(F.get(F.array(*[F.lit(f) for f in folders]), F.col("id").cast("int")).alias("folder"))
    return tasks.mapInPandas(run, "bucket string, file_name string, path string")


def scan_documents(spark: SparkSession, root: str, buckets: list[str] | None = None) -> DataFrame:
    """Whole-text scan of ``<root>/<bucket>/*.md`` without ``*.summary.md`` sidecars.

    Returns (bucket, file_name, stem, text); text has universal newlines.  Folders are
    listed and files opened in the tasks (pyarrow file system, as ``write_vault`` writes
    them): the driver holds no listing, and a task opens many small files.
    """
    import pandas as pd
    file_system = file_systems()

    # the buckets' folders are passed as roots: a listing skips children whose name
    # starts with '_' (such as '_unclassified') or '.'.
    paths = [f"{root.rstrip('/')}/{b}" for b in (buckets or vocab.BUCKETS)]
    paths = [p for p in dict.fromkeys(paths) if path_exists(spark, p)]
    if not paths:
        return spark.createDataFrame([], "bucket string, file_name string, stem string, text string")

    def run(batches):
        filesystem, _ = file_system(root)
        for pdf in batches:
            rows, held = [], 0
            for bucket, name, path in zip(pdf["bucket"], pdf["file_name"], pdf["path"]):
                with filesystem.open_input_file(path) as f:
                    rows.append((bucket, name, f.read()))
                held += len(rows[-1][2])
                if held >= READ_BYTES:
                    yield pd.DataFrame(rows, columns=["bucket", "file_name", "raw"])
                    rows, held = [], 0
            yield pd.DataFrame(rows, columns=["bucket", "file_name", "raw"], dtype=object)

    files = list_files(spark, paths).where(~F.col("file_name").endswith(".summary.md"))
    # a fixed number of tasks: paths are few bytes, by which they would be gathered in one
    files = files.repartition(4 * spark.sparkContext.defaultParallelism, "path")
    df = files.mapInPandas(run, "bucket string, file_name string, raw binary")
    return df.select(
        "bucket",
        "file_name",
        F.regexp_replace("file_name", r"\.md$", "").alias("stem"),
        F.regexp_replace(F.col("raw").cast("string"), r"\r\n?", "\n").alias("text"))


def has_header(text) -> Column:
    return F.coalesce(col(text).rlike(HEADER_RE), F.lit(False))


def header_lines(text) -> Column:
    """Lines of the header block (``splitlines`` semantics); [] without header."""
    raw = F.when(has_header(text), F.regexp_extract(col(text), HEADER_RE, 1))
    return F.coalesce(F.split(raw, LINE_BREAK), F.array().cast("array<string>"))


def header_entries(text) -> Column:
    """Array<struct<key, value>> of the header, skipping lines without ':' and
    lines indented by two spaces; values stripped, then outer quotes removed."""
    lines = header_lines(text)
    kept = F.filter(lines, lambda l: (F.instr(l, ":") > 0) & ~l.startswith("  "))
    return F.transform(kept, lambda l: F.struct(
        py_strip(F.substring_index(l, ":", 1)).alias("key"),
        title_unquote(F.regexp_replace(l, r"\A[^:]*:", "")).alias("value")))


def frontmatter_map(text) -> Column:
    """MAP<STRING,STRING> of the header; the last duplicate key wins."""
    # one fold over the entries: inside a lambda, an expression outside it would be
    # evaluated again for every header line
    empty = F.create_map().cast("map<string,string>")
    return F.aggregate(header_entries(text), empty, lambda seen, e: F.map_concat(
        F.map_filter(seen, lambda k, _: k != e["key"]), F.create_map(e["key"], e["value"])))


def frontmatter_title(text, stem) -> Column:
    """First ``title:`` line of the header, else the stem."""
    first = F.get(F.filter(header_lines(text), lambda l: l.startswith("title:")), 0)
    return F.coalesce(title_unquote(F.regexp_replace(first, r"\A[^:]*:", "")), col(stem))


def section_extract(text, heading: str) -> Column:
    """Body under the first ``## <heading>`` line (case-insensitive, surrounding
    whitespace ignored) up to the next ``## `` heading or the end; stripped."""
    quoted = r"\Q" + heading.replace(r"\E", r"\E\\E\Q") + r"\E"
    pattern = (rf"(?smdiu)^## {WS_NO_NL}*{quoted}{WS_NO_NL}*$(.*?)(?=^## [^\n]|\z)")
    return py_strip(F.regexp_extract(F.coalesce(col(text), F.lit("")), pattern, 1))


def parse_documents(df: DataFrame, text: str = "text", stem: str = "stem") -> DataFrame:
    """Adds has_header, header (map), title and the common header fields."""
    out = df.withColumns({
        "has_header": has_header(text),
        "header": frontmatter_map(text),
        "title": frontmatter_title(text, stem),
    })
    return out.withColumns({
        "status": F.col("header")["ingestion_status"],
        "category": F.col("header")["category"],
        "recorded_at": F.col("header")["recorded_at"],
        "uploaded_at": F.col("header")["uploaded_at"],
        "header_title": F.col("header")["title"],
    })
