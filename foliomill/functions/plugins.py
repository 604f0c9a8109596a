"""Where models and parsers outside the engine plug in: a provider is called once for each Arrow batch."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

Provider = Callable[[list[dict]], list[dict]]


def evaluate(df: DataFrame, make: Callable[[], Provider], schema: str, columns: list[str]) -> DataFrame:
    """``columns`` of each row to the provider made by ``make`` in the worker; its answers come back under ``schema``.

    An answer that lacks a field has null there; a provider that answers more or fewer rows than asked is an error.
    """
    names = [part.split()[0] for part in schema.split(", ")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        provider = make()
        for batch in batches:
            asked = batch.to_dict("records")
            answers = provider(asked)
            if len(answers) != len(asked):
                raise ValueError(f"{len(asked)} rows asked, {len(answers)} answered")
            yield pd.DataFrame([{n: a.get(n) for n in names} for a in answers], columns=names)

    return df.select(*columns).mapInPandas(run, schema)


def constant_provider(answer: dict, *keep: str) -> Callable[[], Provider]:
    """A provider for tests: the same answer for each row, with the columns ``keep`` of what was asked."""
    return lambda: lambda rows: [{**{k: r[k] for k in keep}, **answer} for r in rows]


def questions(key: Column, wanted: dict[str, str]) -> Column:
    """One row for each question about a record: (name, kind), the name being key__question."""
    return F.explode(F.array(*[F.struct(F.concat_ws("__", key, F.lit(q)).alias("name"), F.lit(k).alias("kind")) for q, k in wanted.items()]))


def json_cut(text: Column) -> Column:
    """What stands between the outermost braces, without the fences around; null where there are none."""
    return F.nullif(F.regexp_extract(text, r"(?s)(\{.*\})", 1), F.lit(""))


def bounded(text: Column, most: int) -> Column:
    """At most ``most`` characters, the last of them an ellipsis where something was left out."""
    return F.when(F.length(text) > most, F.concat(F.substring(text, 1, most - 1), F.lit("…"))).otherwise(text)


def parts_text(content: str | list | dict | None) -> str:
    if content is None:
        return ""
    if isinstance(content, str):
        return content
    if isinstance(content, dict):
        return parts_text(content.get("text") or content.get("content"))
    return "".join(parts_text(c) for c in content)


def _grid_texts(node: dict) -> list[str]:
    """Texts of a table's cells by row and column: a grid of rows under ``data``, a list of cells with offsets, or plain cells."""
    data = node.get("data") if isinstance(node.get("data"), dict) else {}
    if isinstance(data.get("grid"), list):
        cells, done = [], set()
        for row in data["grid"]:
            for cell in row if isinstance(row, list) else []:
                # a cell that spans fields stands in each of them
                place = tuple(cell.get(k) for k in ("start_row_offset_idx", "start_col_offset_idx")) if isinstance(cell, dict) else (None, None)
                if None in place or place not in done:
                    done.add(place)
                    cells.append(cell)
    else:
        held = data.get("table_cells") or node.get("cells") or []
        at = lambda c: (c.get("start_row_offset_idx", c.get("row", 0)), c.get("start_col_offset_idx", c.get("col", 0)))
        cells = sorted((c for c in held if isinstance(c, dict)), key=at)
    return [c["text"] for c in cells if isinstance(c, dict) and isinstance(c.get("text"), str)]


def tree_text(payload: str | None) -> str | None:
    """Text of a document tree: the children of ``body`` in reading order, references (``$ref`` or ``ref``, JSON pointers) each
    followed once, table cells by row and column. Without a body, the texts and then the tables as they are stored."""
    if payload is None:
        return None
    tree = json.loads(payload)
    seen: set[str] = set()
    out: list[str] = []

    def at(pointer: str):
        node = tree
        for step in pointer.removeprefix("#/").split("/"):
            step = step.replace("~1", "/").replace("~0", "~")
            node = node[int(step)] if isinstance(node, list) else node[step]
        return node

    waiting = [tree["body"]] if isinstance(tree, dict) and isinstance(tree.get("body"), dict) else []
    while waiting:  # depth first, whatever the depth
        node = waiting.pop()
        if not isinstance(node, dict):
            continue
        pointer = node.get("$ref", node.get("ref"))
        if isinstance(pointer, str):
            if pointer not in seen:
                seen.add(pointer)
                waiting.append(at(pointer))
            continue
        out += [node["text"]] if isinstance(node.get("text"), str) else []
        out += _grid_texts(node)
        waiting += reversed(node.get("children") or [])
    if not out and isinstance(tree, dict):
        out += [n["text"] for n in tree.get("texts") or [] if isinstance(n, dict) and isinstance(n.get("text"), str)]
        out += [t for n in tree.get("tables") or [] if isinstance(n, dict) for t in _grid_texts(n)]
    return "\n".join(x for x in out if x.strip())


@F.pandas_udf(StringType())
def tree_text_of(col: pd.Series) -> pd.Series:
    """Python: a tree walk has no built-in form."""
    return col.map(tree_text)


@F.pandas_udf(StringType())
def content_text_of(col: pd.Series) -> pd.Series:
    """Python: text of JSON content given as a string, an object or a list of parts."""
    return col.map(lambda s: None if s is None else parts_text(json.loads(s)))


#: The names under which providers report what an answer took.
SPELLINGS = {
    "input_tokens": ("$.usage.prompt_tokens", "$.usage.input_tokens"),
    "output_tokens": ("$.usage.completion_tokens", "$.usage.output_tokens"),
    "cost": ("$.usage.cost", "$.usage.total_cost", "$.cost"),
    "answers": ("$.choices[0].message.content", "$.output_text", "$.answers"),
}


def provider_response(raw: Column) -> Column:
    """(answers, input_tokens, output_tokens, cost) of a provider's JSON, whichever names it uses; nulls where it has none or
    is no JSON. Answers given as an object stay JSON text."""
    first = lambda name: F.coalesce(*[F.nullif(F.get_json_object(raw, p), F.lit("")) for p in SPELLINGS[name]])
    number = lambda name, kind: first(name).try_cast(kind).alias(name)
    return F.struct(first("answers").alias("answers"), number("input_tokens", "bigint"), number("output_tokens", "bigint"), number("cost", "double"))
