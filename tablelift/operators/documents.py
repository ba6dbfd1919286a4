"""Checks on XML documents held in a text column.

Parsing happens in Arrow batches inside the tasks; everything around it
(which documents, which expressions, which names are known) is joins.  Documents
travel through a join only where two of them have to meet.
"""

from __future__ import annotations

import xml.etree.ElementTree as ET
from collections.abc import Iterator
from xml.parsers.expat import ExpatError

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablelift.functions import all_matches, path_without_root, shorten
from tablelift.operators.sequence import collect_in_pieces
from tablelift.operators.xpath import Document, Expr, finds, read
from tablelift.scale import lookup_join, materialise

# fixed values: names and tags that are not field references
SPECIAL_NAMES = ("id", "__last_update", "display_name")
ACTION_TAGS = ("button", "a")

# fixed values: where expressions stand in a document, and how much of an error is kept
XPATH_ATTRIBUTE = r"<xpath[^>]+expr=\"([^\"]+)\""
ERROR_LENGTH = 200
MOST_READ = 10_000  # expressions a task keeps read between its batches


def extract_exprs(
    df: DataFrame, column: str, out: str, pattern: str = XPATH_ATTRIBUTE, where: Column | None = None
) -> DataFrame:
    """Rows with at least one match, with all matches of the document and their number."""
    rows = df if where is None else df.where(where)
    found = rows.withColumn(out, all_matches(F.col(column), pattern))
    return found.where(F.size(out) > 0).withColumn(f"n_{out}", F.size(out).cast("long"))


def _parse(text: str | None) -> ET.Element | None:
    """The root element; None for a missing, empty or malformed document, or one that declares a type."""
    if not text or "<!DOCTYPE" in text.upper():
        return None
    try:
        return ET.fromstring(text)
    except (ET.ParseError, ValueError):
        return None


@F.pandas_udf(T.StringType())
def xml_error(texts: pd.Series) -> pd.Series:
    """The parser's message for a malformed document; NULL for a sound or empty one."""

    def message(text: str | None) -> str | None:
        if not text:
            return None
        try:
            ET.fromstring(text)
        except (ET.ParseError, ValueError) as error:
            return str(error)
        return None

    return texts.map(message, na_action="ignore")


def xml_wellformed(df: DataFrame, column: str, out: str = "error") -> DataFrame:
    """Add the parse error, cut to 200 characters; NULL means well-formed.

    Empty and NULL documents pass.  A full parser is used because `from_xml`
    stops at the end of the first element and so accepts trailing text.
    """
    return df.withColumn(out, shorten(xml_error(F.col(column)), ERROR_LENGTH))


def parse_once(views: DataFrame, document: str, tag: str = "xpath") -> DataFrame:
    """`views` with, in place of the document, what the checks ask of it: error, names and exprs.

    `error` is the parser's message (NULL for sound and empty documents),
    `names` the (tag, name) of elements with a name, `exprs` the expressions of
    `<tag expr="…">`.  Documents that declare a type yield no names or expressions.
    """
    kept = [c for c in views.columns if c != document]
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in views.schema.fields if f.name != document]
    schema = ", ".join([*fields, "error string, names array<struct<tag:string,name:string>>, exprs array<string>"])
    pair = pa.struct([("tag", pa.string()), ("name", pa.string())])

    def facts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            errors, names, exprs = [], [], []
            for text in batch.column(document).to_pylist():
                error, root = None, None
                try:
                    root = ET.fromstring(text) if text else None
                except (ET.ParseError, ValueError) as problem:
                    error = str(problem)
                elements = [] if root is None or "<!DOCTYPE" in text.upper() else list(root.iter())
                errors.append(error)
                names.append([{"tag": e.tag, "name": e.get("name")} for e in elements if e.get("name")])
                exprs.append([e.get("expr") for e in elements if e.tag == tag and e.get("expr")])
            made = [pa.array(errors, pa.string()), pa.array(names, pa.list_(pair)), pa.array(exprs, pa.list_(pa.string()))]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], *made], [*kept, "error", "names", "exprs"])

    return views.select(*kept, document).mapInArrow(facts, schema)


def field_names(views: DataFrame, view_id: str, model: str, document: str) -> DataFrame:
    """(view, model, tag, name) for every element with a name attribute."""
    columns = views.select(
        F.col(view_id).alias("view_id"), F.col(model).alias("model"), F.col(document).alias("document")
    )
    id_type = columns.schema["view_id"].dataType.simpleString()

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            origin, tags, names = [], [], []
            for row, text in enumerate(batch.column("document").to_pylist()):
                root = _parse(text)
                if root is None:
                    continue
                for element in root.iter():
                    name = element.get("name")
                    if name:
                        origin.append(row)
                        tags.append(element.tag)
                        names.append(name)
            taken = pa.array(origin, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("view_id").take(taken),
                    batch.column("model").take(taken),
                    pa.array(tags, pa.string()),
                    pa.array(names, pa.string()),
                ],
                ["view_id", "model", "tag", "name"],
            )

    return columns.mapInArrow(explode, f"view_id {id_type}, model string, tag string, name string")


def field_refs_missing(
    views: DataFrame,
    view_id: str,
    model: str,
    document: str,
    fields: DataFrame,
    first_per_model: bool = False,
    names: DataFrame | None = None,
) -> DataFrame:
    """References to fields their model does not have.

    ``fields`` lists (model, name).  Models it does not know are skipped, as
    are special names, dotted paths, buttons and links.  By default all views
    are checked; ``first_per_model`` looks at the lowest id of each model only.
    Documents are parsed where they are read; only names travel through joins.
    `names` (view_id, model, tag, name) may come from an earlier parse.
    """
    if names is None:
        names = field_names(views.where(F.col(model).isNotNull()), view_id, model, document)
    names = names.where(
        ~F.col("name").isin(*SPECIAL_NAMES) & ~F.col("tag").isin(*ACTION_TAGS) & ~F.col("name").contains(".")
    )
    if first_per_model:
        firsts = views.where(F.col(model).isNotNull()).groupBy(F.col(model).alias("model")).agg(F.min(view_id).alias("view_id"))
        names = lookup_join(names, firsts, ["model", "view_id"], "left_semi")
    names = lookup_join(names, fields.select("model").distinct(), "model", "left_semi")
    known = fields.select("model", "name").distinct()
    return lookup_join(names, known, ["model", "name"], "left_anti").select("view_id", "model", "tag", "name")


NOT_CHECKABLE = "not checkable here"
INHERITS = f"{NOT_CHECKABLE}: the parent inherits"
INVALID = "invalid expression"


def has_doctype(document: Column) -> Column:
    """Documents that declare a type could name files to open; they are never evaluated."""
    return F.contains(F.upper(document), F.lit("<!DOCTYPE"))


def _document_exprs(views: DataFrame, view_id: str, parent: str, document: str, tag: str) -> DataFrame:
    """(view_id, parent_id, expr) for every `<tag expr="…">` of a well-formed document."""
    columns = views.select(
        F.col(view_id).alias("view_id"), F.col(parent).alias("parent_id"), F.col(document).alias("document")
    )
    id_type = columns.schema["view_id"].dataType.simpleString()
    parent_type = columns.schema["parent_id"].dataType.simpleString()

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            origin, exprs = [], []
            for row, text in enumerate(batch.column("document").to_pylist()):
                root = _parse(text)
                if root is None:
                    continue
                for element in root.iter(tag):
                    expression = element.get("expr")
                    if expression:
                        origin.append(row)
                        exprs.append(expression)
            taken = pa.array(origin, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("view_id").take(taken), batch.column("parent_id").take(taken), pa.array(exprs, pa.string())],
                ["view_id", "parent_id", "expr"],
            )

    return columns.mapInArrow(explode, f"view_id {id_type}, parent_id {parent_type}, expr string")


def _evaluate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One parent document per row against its own list of expressions; hits are left out.

    A task reads each distinct expression once and each document once.
    """
    known: dict[str, Expr | str] = {}
    for batch in batches:
        if len(known) > MOST_READ:
            known.clear()
        origin, missed, errors = [], [], []
        lists, inherits = batch.column("exprs").to_pylist(), batch.column("inherits").to_pylist()
        for row, text in enumerate(batch.column("document").to_pylist()):
            try:
                document = Document(text)
            except (ExpatError, ValueError):
                continue
            for expression in lists[row]:
                expr = known.get(expression) or known.setdefault(expression, read(expression))
                if isinstance(expr, str) or not finds(expr, document):
                    origin.append(row)
                    missed.append(expression)
                    errors.append(f"{INVALID}: {expr}" if isinstance(expr, str) else INHERITS if inherits[row] else None)
        taken = pa.array(origin, pa.int64())
        columns = [batch.column("parent_id").take(taken), pa.array(missed, pa.string()), pa.array(errors, pa.string())]
        yield pa.RecordBatch.from_arrays(columns, ["parent_id", "expr", "error"])


def expr_targets_missing(
    views: DataFrame, view_id: str, parent: str, document: str, tag: str = "xpath", where: Column | None = None,
    entries: int = 1000, found: DataFrame | None = None,
) -> DataFrame:
    """Expressions of a document that find nothing in its parent's document.

    (view_id, parent_id, expr, error).  `error` is NULL where the expression was
    evaluated and found nothing, and says "invalid expression" where XPath 1.0
    rejects it.  It says "not checkable here" where a miss cannot be told: the
    parent inherits itself, so that the target may lie in what it inherits.
    Pairs where either document does not parse or declares a document type are
    skipped; other checks report those.

    Each distinct (parent, expression) is evaluated once, inside the tasks and
    only on its own document, by all of XPath 1.0 (`xpath.py`), starting at the
    root element; a parent's document travels once per list of at most `entries`
    expressions.  No job depends on how many expressions there are.
    The expressions `found` (view_id, parent_id, expr) may come from an earlier parse.
    """
    usable = F.col(document).isNotNull() & (F.col(document) != "") & ~has_doctype(F.col(document))
    if found is None:
        children = views if where is None else views.where(where)
        found = _document_exprs(children.where(F.col(parent).isNotNull() & usable), view_id, parent, document, tag)
    rows = materialise(found, "exprs")
    pairs = rows.select("parent_id", "expr").distinct()
    lists = collect_in_pieces(pairs, "parent_id", "expr", "exprs", entries=entries).select("parent_id", "exprs")
    documents = views.where(usable).select(
        F.col(view_id).alias("parent_id"), F.col(document).alias("document"), F.col(parent).isNotNull().alias("inherits")
    )
    parent_type = rows.schema["parent_id"].dataType.simpleString()
    judged = (
        lookup_join(lists, documents, "parent_id", "inner")
        .select("parent_id", "exprs", "document", "inherits")
        .mapInArrow(_evaluate, f"parent_id {parent_type}, expr string, error string")
    )
    misses = materialise(judged.distinct(), "misses")
    return lookup_join(rows, misses, ["parent_id", "expr"], "inner").select("view_id", "parent_id", "expr", "error")


def normalise_paths(df: DataFrame, path: str, out: str = "normal") -> DataFrame:
    """Rows with a checkable path: not empty, one leading slash stripped, no glob."""
    return df.withColumn(out, path_without_root(F.col(path))).where(F.col(out).isNotNull())


def missing_paths(df: DataFrame, path: str, manifest: DataFrame, listed: str, out: str = "normal") -> DataFrame:
    """Normalised paths the manifest does not list."""
    files = manifest.select(F.col(listed).alias(out)).distinct()
    return lookup_join(normalise_paths(df, path, out), files, out, "left_anti")


