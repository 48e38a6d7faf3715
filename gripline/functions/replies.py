"""Column expressions for model replies: find the JSON in a reply, read and normalise its fields."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from gripline.functions.literals import literal_json
from gripline.functions.text import let, number_of, strip

# --- fixed values -----------------------------------------------------------------
MARKERS = ("```json", "```", "JSON:", "Response:")
OBJECT_KEYS = ("target_object", "object", "target", "label")
BOX_KEYS = ("bbox", "bbox_2d", "box")
CENTER_KEYS = ("center", "center_xy")
NUMBER_IN_TEXT = r"(-?\d+(?:\.\d+)?)"

STRICT = {"allowSingleQuotes": "false"}
LOOSE = {"allowSingleQuotes": "false", "allowUnquotedControlChars": "true"}


def _only_value(text: Column, options: dict) -> Column:
    """The text as one JSON value and nothing after it: wrapped in brackets it must hold one element."""
    items = F.from_json(F.concat(F.lit("["), text, F.lit("]")), "array<string>", options)
    return let(items, lambda found: F.when(F.size(found) == 1, F.get(found, 0)))


def _braces(text: Column) -> Column:
    return F.nullif(F.regexp_extract(text, r"(?s)(\{.*\})", 1), F.lit(""))


def strip_thinking(text: Column) -> Column:
    return strip(F.regexp_replace(text, r"(?s)<think>.*?</think>", ""))


def extract_json(text: Column) -> Column:
    """Text of the outermost {...} of a reply when it is valid JSON, else null."""
    return _only_value(_braces(strip_thinking(text)), STRICT)


def segment_list(body: Column) -> Column:
    """Planned segments in the JSON of a reply; an entry that is not an object is left out.

    A frame written as text counts only when it is a whole number."""

    def frame(entry: Column, key: str) -> Column:
        value = F.try_variant_get(entry, f"$.{key}", "variant")
        text = F.try_variant_get(entry, f"$.{key}", "string")
        return F.when((F.schema_of_variant(value) != "STRING") | text.rlike(r"^\s*[+-]?\d+\s*$"), text)

    def segment(item: Column) -> Column:
        fields = lambda v: F.struct(
            frame(v, "start_frame").alias("start_frame"), frame(v, "end_frame").alias("end_frame"), F.try_variant_get(v, "$.subtask_instruction", "string").alias("subtask_instruction")
        )
        return let(F.try_parse_json(item), fields)

    items = F.from_json(body, "struct<subtask_segments:array<string>>")["subtask_segments"]
    return F.transform(F.filter(items, lambda x: x.startswith("{")), segment)


def strip_markers(text: Column) -> Column:
    out = strip(text)
    for marker in MARKERS:
        out = F.replace(out, F.lit(marker), F.lit(""))
    return strip(out)


def parse_grounding(text: Column) -> Column:
    """Reply -> JSON text of its object.

    Tried in turn: JSON, a Python literal, JSON between the outer braces. Of a list the first element counts. Null when no object is found.
    """

    def read(bare: Column) -> Column:
        return F.coalesce(_only_value(bare, LOOSE), _only_value(literal_json(bare), STRICT), _only_value(_braces(bare), LOOSE))

    def first(root: Column) -> Column:
        return F.when(root.startswith("["), F.get(F.from_json(root, "array<string>"), 0)).otherwise(root)

    root = let(strip_markers(text), read)
    return let(let(root, first), lambda body: F.when(body.startswith("{"), body))


def _filled(body: Column, key: str) -> Column:
    """{text, kind} of a key; null when its value counts as empty."""
    value = F.try_variant_get(body, f"$.{key}", "variant")

    def check(found: Column) -> Column:
        text, kind = found["text"], found["kind"]
        number = F.coalesce(text.try_cast("double") == 0, F.lit(False))
        hollow = (kind != "STRING") & (number | text.isin("[]", "{}", "false"))
        return F.when(text.isNotNull() & (text != "") & ~hollow, found)

    both = let(value, lambda x: F.struct(F.try_variant_get(x, "$", "string").alias("text"), F.schema_of_variant(x).alias("kind")))
    return let(both, check)


def first_value(body: Column, keys: tuple[str, ...]) -> Column:
    """{text, kind} of the first key with a value; kind tells a list from a text that looks like one."""
    return F.coalesce(*[_filled(body, key) for key in keys])


def numbers_of(value: Column, count: int) -> Column:
    """Exactly `count` numbers out of a list, or the first ones found in a text; else null."""
    listed = F.when(value["kind"].startswith("ARRAY"), F.transform(F.from_json(value["text"], "array<string>"), number_of))
    written = F.when(
        value["kind"] == "STRING",
        F.slice(F.regexp_extract_all(value["text"], F.lit(NUMBER_IN_TEXT), 1), 1, count).cast("array<double>"),
    )
    whole = lambda x: F.when((F.size(x) == count) & F.forall(x, lambda v: v.isNotNull()), x)
    return let(F.coalesce(listed, written), whole)


def numbers_in_text(text: Column, count: int) -> Column:
    found = F.slice(F.regexp_extract_all(text, F.lit(NUMBER_IN_TEXT), 1), 1, count).cast("array<double>")
    return let(found, lambda x: F.when(F.size(x) == count, x))


def _clamp(value: Column, top: Column) -> Column:
    return F.greatest(F.lit(0.0), F.least(value, top.cast("double")))


def normalize_bbox(box: Column, width: Column, height: Column) -> Column:
    """Order the corners, clamp to the image; null when not four numbers or without area."""
    a, b, c, d = (F.get(box, i) for i in range(4))
    x1, x2 = _clamp(F.least(a, c), width), _clamp(F.greatest(a, c), width)
    y1, y2 = _clamp(F.least(b, d), height), _clamp(F.greatest(b, d), height)
    return F.when((F.size(box) == 4) & (x2 > x1) & (y2 > y1), F.array(x1, y1, x2, y2))


def normalize_center(center: Column, width: Column, height: Column) -> Column:
    cx, cy = F.get(center, 0), F.get(center, 1)
    return F.when(F.size(center) == 2, F.array(_clamp(cx, width), _clamp(cy, height)))


def box_center(box: Column) -> Column:
    mid = lambda b, i, j: (F.get(b, i) + F.get(b, j)) / 2.0
    return let(box, lambda b: F.when(b.isNotNull(), F.array(mid(b, 0, 2), mid(b, 1, 3))))


def model_reply(response: Column) -> Column:
    """Text of the first choice: its content, else its reasoning, else nothing."""
    parsed = F.from_json(response, "choices array<struct<message:struct<content:string,reasoning:string>>>")
    message = F.get(parsed["choices"], 0)["message"]
    filled = lambda c: F.when(c != "", c)
    return F.coalesce(filled(message["content"]), filled(message["reasoning"]), F.lit(""))
