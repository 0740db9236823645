"""Where pages and answers come from: paths, page ranges, recorded answers, training rows, made-up values."""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import Protocol

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from veilframe.functions.checks import ocr_status, rrn_check_digit
from veilframe.functions.geometry import quad_to_box
from veilframe.functions.numeric import draw


class Provider(Protocol):
    """Something that answers for crops or tiles: a model behind a server, or a recording."""

    def answer(self, requests: DataFrame) -> DataFrame: ...


class Recorded:
    """Answers that were stored before, looked up by the request's key columns."""

    def __init__(self, answers: DataFrame, keys: list[str]) -> None:
        self.answers, self.keys = answers, keys

    def answer(self, requests: DataFrame) -> DataFrame:
        return requests.join(self.answers, self.keys, "left")


class Called:
    """Answers that `call(rows)` fetches, one client for each partition; failures become rows with an error."""

    def __init__(self, make_client, schema: str) -> None:
        self.make_client, self.schema = make_client, schema

    def answer(self, requests: DataFrame) -> DataFrame:
        make = self.make_client

        def run(batches: Iterator) -> Iterator:
            call = make()
            for b in batches:
                yield call(b)

        return requests.mapInPandas(run, self.schema)


def files(spark: SparkSession, path: str) -> DataFrame:
    """path, kind (pdf or image) and content of files below a folder."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", file_kind(F.col("path")).alias("kind"), "content")


def file_kind(path: Column) -> Column:
    return F.when(F.lower(path).endswith(".pdf"), "pdf").otherwise("image")


def render_scale(width_pt: Column, height_pt: Column, target: int | None = 2464) -> Column:
    """Enlargement that brings a PDF page's longer side to target; 2 where either is missing."""
    longest = F.greatest(width_pt, height_pt)
    if not target:
        return F.lit(2.0)
    return F.when(longest > 0, F.least(F.lit(8.0), F.greatest(F.lit(0.5), target / longest))).otherwise(2.0)


def page_numbers(spec: Column, n_pages: Column) -> Column:
    """Sorted distinct page numbers of "1-3,7,10-"; blank means all. Malformed, empty or out-of-range parts raise an error."""
    parts = F.filter(F.transform(F.split(spec, ","), lambda p: F.trim(p)), lambda p: p != "")

    def one(p: Column) -> Column:
        lo, hi = F.regexp_extract(p, r"^(\d*)-?(\d*)$", 1), F.regexp_extract(p, r"^(\d*)-?(\d*)$", 2)
        low = F.when(lo == "", F.lit(1)).otherwise(lo.try_cast("int"))
        high = F.when(~p.contains("-"), low).when(hi == "", n_pages).otherwise(hi.try_cast("int"))
        bad = ~p.rlike(r"^\d*-?\d*$") | (p == "-") | (low < 1) | (high < low) | (low > n_pages)
        return F.when(bad, F.raise_error(F.concat(F.lit("bad page range: "), p)).cast("array<int>")).otherwise(F.sequence(low, F.least(high, n_pages)))

    every = F.when(n_pages > 0, F.sequence(F.lit(1), n_pages)).otherwise(F.array().cast("array<int>"))
    return F.when(F.trim(F.coalesce(spec, F.lit(""))) == "", every).otherwise(F.array_sort(F.array_distinct(F.flatten(F.transform(parts, one)))))


def parse_ocr(raw: DataFrame) -> DataFrame:
    """Boxes of OCR answers: raw (page, ord, entries: array of quad, text, conf); entries without a quad go."""
    e = raw.select("page", "ord", F.posexplode("entries").alias("idx", "e")).filter("e.quad IS NOT NULL AND size(e.quad) > 0")
    text, conf = F.trim(F.coalesce("e.text", F.lit(""))), F.round(F.coalesce("e.conf", F.lit(0.0)), 4)
    return e.select("page", "ord", "idx", quad_to_box(F.col("e.quad")).alias("bbox"), text.alias("text"), conf.alias("conf"), ocr_status(text, conf).alias("status"))


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, line, value): the lines of text files with their numbers from 1.

    A file is read in parts by several tasks: lines are numbered within their part, and a part starts where the counts
    of the file's parts before it end.
    """
    m = F.col("_metadata")
    rows = spark.read.text(path).select("value", m["file_path"].alias("file"), m["file_block_start"].alias("block"), F.monotonically_increasing_id().alias("_id"))
    parts = rows.groupBy("file", "block").agg(F.count("*").alias("_n"), F.min("_id").alias("_first"))
    before = F.sum("_n").over(Window.partitionBy("file").orderBy("block")) - F.col("_n")
    return rows.join(parts.withColumn("_before", before), ["file", "block"]).select("file", (F.col("_before") + F.col("_id") - F.col("_first") + 1).alias("line"), "value")


def read_training_rows(spark: SparkSession, path: str, strict: bool = True) -> DataFrame:
    """Rows of jsonl files: file, line, image, task (locate where absent), query, target, problem. Blank lines are skipped.

    A line that is no object, has no image, has another task, or asks for nothing, raises an error that names
    file and line; with strict off it is kept with its problem.
    """
    schema = "image string, task string, query array<string>, target struct<findings:array<struct<text:string,bbox_2d:array<int>>>>"
    lines = numbered_lines(spark, path).filter(F.trim("value") != "")
    r = lines.select("file", "line", F.from_json("value", schema).alias("r")).select("file", "line", "r.image", F.coalesce("r.task", F.lit("locate")).alias("task"), "r.query", "r.target")
    problem = F.when(F.coalesce(F.trim("image"), F.lit("")) == "", "no image").when(~F.col("task").isin("locate", "read"), "unknown task").when((F.col("task") == "locate") & (F.coalesce(F.size("query"), F.lit(0)) <= 0), "nothing asked")
    if strict:
        where = F.concat(F.col("file"), F.lit(":"), F.col("line").cast("string"), F.lit(": "), problem)
        problem = F.when(problem.isNotNull(), F.raise_error(where).cast("string"))
        # the image depends on the check, so that no choice of columns goes round it
        r = r.withColumn("image", F.coalesce(problem, F.col("image")))
        problem = F.lit(None).cast("string")
    return r.withColumn("problem", problem)


class Decoder(Protocol):
    """What opens a document: a PDF library, on the executors. A document has a length, size(i) in points, and render(i, scale)."""

    def __call__(self, content: bytes, password: str | None): ...


POINTS = 72.0
PDF_PAGE = "path string, page_no int, n_pages int, page_w int, page_h int, scale double, dpi double, image binary, error string"


def pdf_pages(documents: DataFrame, decoder: Decoder, spec: str = "", target: int | None = 2464, password: str | None = None) -> DataFrame:
    """Rows of PDF_PAGE: the selected pages (page_numbers) of documents (path, content), each rendered when its turn comes.

    render gives (width, height, image bytes). A document that can't be opened or has no pages is one row with an
    error, so the others go on.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [x.split()[0] for x in PDF_PAGE.split(", ")]
        kinds = [pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.float64(), pa.float64(), pa.binary(), pa.string()]

        def row(*values):
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds, strict=True)], names)

        for b in batches:
            for path, content in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                try:
                    opened = decoder(content, password)
                    if not len(opened):
                        raise ValueError("no pages")
                    chosen = select_pages(spec, len(opened))
                except Exception as e:  # noqa: BLE001 - whatever a decoder raises concerns this document only
                    yield row(path, *[None] * 7, f"{type(e).__name__}: {e}")
                    continue
                for no in chosen:
                    scale = page_scale(*opened.size(no - 1), target)
                    w, h, image = opened.render(no - 1, scale)
                    yield row(path, no, len(opened), w, h, round(scale, 4), round(scale * POINTS, 1), image, None)

    return documents.select("path", "content").mapInArrow(run, PDF_PAGE)


def page_counts(documents: DataFrame, decoder: Decoder, password: str | None = None) -> DataFrame:
    """(path, n_pages, error) of documents (path, content), without rendering."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            counts, errors = [], []
            for content in b.column(1).to_pylist():
                try:
                    counts.append(len(decoder(content, password)))
                    errors.append(None)
                except Exception as e:  # noqa: BLE001
                    counts.append(None)
                    errors.append(f"{type(e).__name__}: {e}")
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(counts, pa.int32()), pa.array(errors, pa.string())], ["path", "n_pages", "error"])

    return documents.select("path", "content").mapInArrow(run, "path string, n_pages int, error string")


def page_scale(width_pt: float, height_pt: float, target: int | None) -> float:
    """render_scale() of plain numbers."""
    longest = max(width_pt or 0, height_pt or 0)
    return min(8.0, max(0.5, target / longest)) if target and longest > 0 else 2.0


def select_pages(spec: str | None, n_pages: int) -> list[int]:
    """page_numbers() of plain values."""
    wanted: set[int] = set()
    parts = [p.strip() for p in (spec or "").split(",") if p.strip()]
    for part in parts or ([f"1-{n_pages}"] if not (spec or "").strip() else []):
        ends = re.fullmatch(r"(\d*)(-?)(\d*)", part, re.ASCII)
        if not ends or part == "-":
            raise ValueError(f"bad page range: {part}")
        low = int(ends[1] or 1)
        high = low if not ends[2] else int(ends[3] or n_pages)
        if not 1 <= low <= min(high, n_pages):
            raise ValueError(f"bad page range: {part}")
        wanted.update(range(low, min(high, n_pages) + 1))
    return sorted(wanted)


def made_up_values(keys: DataFrame, seed: int = 0) -> DataFrame:
    """Values of each kind for keys (id), right in their checksums: rrn, card, phone, account, ip, passport, email, biz_no.

    biz_no has no checksum: it is a number that must not be reported.
    """
    of = lambda salt, n: draw(seed, salt, F.col("id"), n)
    pad = lambda c, n: F.lpad(c.cast("string"), n, "0")
    first = F.concat(pad(of("y", 100), 2), pad(of("m", 12) + 1, 2), pad(of("d", 28) + 1, 2), pad(of("g", 4) + 1, 1), pad(of("s", 100_000), 5))
    rrn = F.concat(F.substring(first, 1, 6), F.lit("-"), F.substring(first, 7, 6), rrn_check_digit(first).cast("string"))
    body = F.concat(F.lit("4"), pad(of("c", 10**14), 14))
    doubled = F.transform(F.sequence(F.lit(1), F.lit(15)), lambda i: F.substring(body, i, 1).cast("int") * (1 + i % 2))
    total = F.aggregate(doubled, F.lit(0), lambda s, x: s + F.when(x > 9, x - 9).otherwise(x))
    card = F.concat(body, ((10 - total % 10) % 10).cast("string"))
    return keys.select(
        "id", rrn.alias("rrn"), card.alias("card"), F.concat(F.lit("010-"), pad(of("p", 10**4), 4), F.lit("-"), pad(of("q", 10**4), 4)).alias("phone"),
        F.concat(pad(of("a", 1000), 3), F.lit("-"), pad(of("b", 10**6), 6), F.lit("-"), pad(of("e", 10**5), 5)).alias("account"),
        F.concat(F.lit("10."), of("i", 256), F.lit("."), of("j", 256), F.lit("."), (of("k", 254) + 1)).alias("ip"),
        F.concat(F.lit("M"), pad(of("t", 10**8), 8)).alias("passport"), F.concat(F.lit("user"), of("u", 10**6), F.lit("@example.com")).alias("email"),
        F.concat((of("x", 900) + 100).cast("string"), F.lit("-"), (of("z", 90) + 10).cast("string"), F.lit("-"), pad(of("w", 10**5), 5)).alias("biz_no"),
    )
