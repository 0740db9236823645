"""Answers of a model: recovery of malformed JSON, typed items, and the JSON that is written."""

from __future__ import annotations

import contextlib
import json
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

ROOT = "findings"
ITEM = "struct<text:string,type:string,field:string,bbox_2d:array<double>,conf:double>"
ANSWER = T.StructType().add("items", "string").add("salvaged", "boolean").add("error", "string")
_FENCE = re.compile(r"^```[A-Za-z]*\s*|\s*```$")


#: What matters to where an object ends: strings, in which brackets don't count, and brackets.
_PIECE = re.compile(r'"(?:[^"\\]|\\.)*"|[{}\[\]]', re.DOTALL)


def _objects(text: str) -> Iterator[dict]:
    """The objects that a text begins with, apart by spaces and commas, up to the first that is torn or wrong."""
    depth, begin, end = 0, 0, 0
    for piece in _PIECE.finditer(text):
        if not depth:
            if piece[0] != "{" or not re.fullmatch(r"[\s,]*", text[end : piece.start()]):
                return
            begin = piece.start()
        depth += {"{": 1, "[": 1, "}": -1, "]": -1}.get(piece[0], 0)
        if not depth:
            end = piece.end()
            try:
                yield json.loads(text[begin:end])
            except ValueError:
                return


def salvage(raw: str, root: str = ROOT) -> dict | None:
    """What can be parsed of an answer that is no proper object, or None. No value is guessed.

    That is the object or list behind a code fence, or else the objects at the begin: the items of all
    that have a list of them, or, if none has, the objects as items.
    """
    text = raw.strip()
    while (bare := _FENCE.sub("", text)) != text:
        text = bare
    found: list = list(_objects(text))
    with contextlib.suppress(ValueError):
        if isinstance(whole := json.loads(text), dict):
            return whole
        found = [x for x in whole if isinstance(x, dict)] if isinstance(whole, list) else found
        return {root: found} if isinstance(whole, list) else None
    lists = [x[root] for x in found if isinstance(x.get(root), list)]
    items = [i for own in lists for i in own if isinstance(i, dict)] if lists else found
    return {root: items} if found else None


def read_answer(raw: str | None) -> tuple[str | None, bool, str | None]:
    """Items as a JSON array, whether they had to be salvaged, and the parser's complaint."""
    if raw is None:
        return None, False, "no answer"
    said = None
    try:
        value = json.loads(raw)
        if not isinstance(value, dict):
            said = "no object"
    except ValueError as e:
        said = str(e)
    if said is not None:
        value = salvage(raw)
        if value is None:
            return None, False, said
    items = value.get(ROOT)
    return json.dumps([x for x in items if isinstance(x, dict)] if isinstance(items, list) else [], ensure_ascii=False), said is not None, said


@F.pandas_udf(ANSWER)
def parse_answer(raws: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([read_answer(r) for r in raws], columns=ANSWER.names)


def typed_items(items: Column) -> Column:
    """Array of items with their types; absent texts are empty, an absent confidence is 0, items without a type go."""
    loose = F.from_json(items, "array<map<string,string>>")
    numbers = lambda m: F.when(m["bbox_2d"].rlike(r"^\s*\["), F.from_json(m["bbox_2d"], "array<double>"))
    typed = F.transform(loose, lambda m: F.struct(F.coalesce(m["text"], F.lit("")).alias("text"), m["type"].alias("type"), F.coalesce(m["field"], F.lit("")).alias("field"), numbers(m).alias("bbox_2d"), F.coalesce(m["conf"].try_cast("double"), F.lit(0.0)).alias("conf")))
    return F.filter(typed, lambda i: F.coalesce(i["type"], F.lit("")) != "")


def compact(value: Column) -> Column:
    """JSON without spaces, keys in the order of the struct."""
    return F.to_json(value)
