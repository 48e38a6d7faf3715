"""Column expressions over text: instructions, numbers and lists written as text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: texts that stand for "no value" -------------------------------
MISSING = ("", "[]", "-1")
MISSING_GROUNDING = ("", "[]", "-1", "None", "nan")

# --- fixed values: manipulation verbs, their category, verbs needing precision ----
VERB_CATEGORY = {
    "pick": "pick-and-place",
    "grab": "pick-and-place",
    "place": "pick-and-place",
    "put": "pick-and-place",
    "open": "articulated",
    "close": "articulated",
    "pour": "tool-use",
    "wipe": "tool-use",
    "push": "non-prehensile",
    "slide": "non-prehensile",
    "insert": "pick-and-place",
    "stack": "pick-and-place",
}
PRECISION_VERBS = ("insert", "stack", "pour", "place")

# --- fixed values: display names of the gripper phases ---------------------------
PHASE_DISPLAY = {
    "pre_grasp": "pre-grasp",
    "immobilization": "approach",
    "contact": "contact",
    "detach": "detach",
    "post_grasp": "post-grasp",
    "transition": "transition",
}

# --- fixed values: which of the three subtasks belongs to a manipulation phase ----
SUBTASK_OF_PHASE = {"approach": 0, "stabilize": 0, "contact": 1, "release": 2, "reset": 2}

VIDEO_TOKEN = "<__dj__video>"  # fixed value: marks the video slot in a sample text

_NUMBER = r"^[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?$"


def literal_map(values: dict) -> Column:
    return F.create_map(*[F.lit(x) for pair in values.items() for x in pair])


#: A list, or a tuple with a comma, of bare numbers and blanks; a list of lists of two such numbers; texts that hold a sign no such list has, or no digit, True or False.
_BARE = r"[+-]?(?:\d++(?:\.\d*+)?|\.\d++)(?:[eE][+-]?\d++)? *+"
_PLAIN_LIST = rf"^ *+(?:\[ *+{_BARE}(?:, *+{_BARE})*+(?:, *+)?\]|\( *+{_BARE}(?:(?:, *+{_BARE})++(?:, *+)?|, *+)\)) *+$"
_PAIR = rf"\[ *+{_BARE}, *+{_BARE}\] *+"
_PLAIN_TRACE = rf"^ *+\[ *+{_PAIR}(?:, *+{_PAIR})*+\] *+$"
_NO_LIST = r"[A-DG-SU-Zb-df-kmnopqtv-z]|^[^0-9TF]*+$"

#: What a name keeps and letters whose lower case is kept, without the underscore; the first 80 of them with all between.
_NAMED = r"A-Za-z0-9.\u0130\u212A-"
_NAME_HEAD = rf"^[^{_NAMED}]*+((?:[^{_NAMED}]*+[{_NAMED}]){{0,80}}+)"


def let(value: Column, body) -> Column:
    """body(value) with the value computed once."""
    return F.get(F.transform(F.array(value), body), 0)


def strip(text: Column) -> Column:
    """Remove white space of every kind at both ends."""
    return F.regexp_replace(text.cast("string"), r"(?U)^\s+|\s+$", "")


def words(text: Column) -> Column:
    """Split on white space; a blank text has no words."""
    bare = strip(F.coalesce(text, F.lit("")))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, r"(?U)\s+"))


def parse_text(value: Column, missing: tuple[str, ...] = MISSING) -> Column:
    """Stripped text, or the empty text when it only says that nothing is there."""
    bare = strip(value)
    return F.when(bare.isNull() | bare.isin(*missing), F.lit("")).otherwise(bare)


def parse_int_like(value: Column, keep_negative: bool = False) -> Column:
    """Whole part of a number written as text; null when blank, bad or (by default) negative."""
    bare = strip(value)
    whole = F.when(bare.rlike(_NUMBER), bare.try_cast("double").try_cast("bigint"))
    return whole if keep_negative else F.when(whole >= 0, whole)


def number_of(item: Column) -> Column:
    """A number written as text, null for anything else."""
    bare = strip(item)
    return F.when(bare.rlike(_NUMBER), bare.try_cast("double"))


def _as_digits(text: Column) -> Column:
    """Numbers in the spelling of a Python literal that others do not read: True, False and underscores between digits."""
    word = lambda t, name, digit: F.regexp_replace(t, rf"(?<=[\[(,\s]|^){name}(?=[\s,)\]]|$)", digit)
    plain = word(word(F.regexp_replace(text, r"(?<=\d)_(?=\d)", ""), "True", "1"), "False", "0")
    return F.when(text.rlike("[_TF]"), plain).otherwise(text)


def _items(text: Column) -> Column:
    """Numbers of a list, of a tuple or of two or more items between commas; null for anything else. Items may be quoted."""

    def items(bare: Column) -> Column:
        inner = F.regexp_replace(F.regexp_replace(bare, r"^[\[(]|[\])]$", ""), r",\s*$", "")
        item = lambda x: let(F.regexp_replace(strip(x), r"""^(['"])(.*)\1$""", "$2"), number_of)
        listed = bare.rlike(r"^(?:\[[^\[\]()]*\]|\([^\[\]()]*,[^\[\]()]*\)|[^\[\]()]*,[^\[\]()]*)$")
        return F.when(listed, F.transform(F.split(inner, ","), item))

    return let(strip(text), items)


def vector_or_null(values: Column) -> Column:
    """An array without gaps, or null when it is empty or has a missing element."""
    ok = (F.size(values) > 0) & F.forall(values, lambda x: x.isNotNull())
    return F.when(ok, values)


def parse_vector(value: Column) -> Column:
    """List of numbers written as text -> array<double>; null when blank, empty or bad.

    Plain lists are cut at their commas, and texts that no list of numbers can be are known by one look; only others are read item by item.
    """
    plain = F.split(F.rtrim(F.translate(value, "[]() ", ""), F.lit(",")), ",").try_cast("array<double>")
    return F.when(value.rlike(_PLAIN_LIST), plain).when(~value.rlike(_NO_LIST), let(_items(_as_digits(value)), vector_or_null))


def parse_trace(value: Column) -> Column:
    """Points written as text -> array of [u, v]; one short point voids the whole trace.

    Plain lists of pairs are cut at their commas; only others are read point by point.
    """
    point = r"[\[(][^\[\]()]*+[\])]"

    def points(bare: Column) -> Column:
        listed = bare.rlike(rf"^[\[(]\s*+(?:{point}\s*+(?:,\s*+|(?=[\])]$)))*+[\])]$")
        return F.when(listed, F.transform(F.regexp_extract_all(bare, F.lit(rf"{point}(?=\s*[,\])])"), F.lit(0)), _items))

    numbers = F.split(F.translate(value, "[] ", ""), ",").try_cast("array<double>")
    pairs = lambda n: F.transform(F.sequence(F.lit(0), F.size(n) - 2, F.lit(2)), lambda i: F.array(F.get(n, i), F.get(n, i + 1)))
    read = let(let(_as_digits(strip(value)), points), trace_or_null)
    return F.when(value.rlike(_PLAIN_TRACE), let(numbers, pairs)).when(value != "", read)


def trace_or_null(points: Column) -> Column:
    whole = F.forall(
        points,
        lambda p: p.isNotNull() & (F.size(p) >= 2) & F.get(p, 0).isNotNull() & F.get(p, 1).isNotNull(),
    )
    return F.when((F.size(points) > 0) & whole, F.transform(points, lambda p: F.slice(p, 1, 2)))


def task_verb(tokens: Column) -> Column:
    known = F.filter(tokens, lambda t: t.isin(*VERB_CATEGORY))
    return F.coalesce(F.get(known, 0), F.lit("unknown"))


def task_object(tokens: Column) -> Column:
    last = F.get(tokens, F.size(tokens) - 1)
    return F.coalesce(F.regexp_replace(last, r"[.,]+$", ""), F.lit("unknown"))


def subtask_sequence(verb: Column, obj: Column) -> Column:
    """Three fixed sentence forms: reach, act, go home."""
    return F.array(
        F.concat(F.lit("reach toward the "), obj),
        F.concat(verb, F.lit(" the "), obj),
        F.lit("return to home position"),
    )


def subtask_of_phase(sequence: Column, phase: Column) -> Column:
    index = F.coalesce(F.element_at(literal_map(SUBTASK_OF_PHASE), phase), F.lit(0))
    return F.coalesce(F.get(sequence, index), F.lit(""))


def phase_alias(phase: Column, style: str = "hyphen") -> Column:
    if style == "robo2vlm":
        return phase
    return F.coalesce(F.element_at(literal_map(PHASE_DISPLAY), phase), F.replace(phase, F.lit("_"), F.lit("-")))


def safe_name(text: Column) -> Column:
    """File-name part: lower case, other characters joined to one underscore, 80 characters at most.

    Only the part of the text that the name comes from is rewritten: up to the 80th sign that is kept and no underscore.
    """
    head = F.regexp_extract(text.cast("string"), _NAME_HEAD, 1)
    plain = F.regexp_replace(F.lower(head), r"[^A-Za-z0-9._-]+", "_")
    cut = F.substring(F.regexp_replace(plain, r"^_+|_+$", ""), 1, 80)
    return F.when(cut == "", F.lit("subtask")).otherwise(cut)


def parse_fps(text: Column) -> Column:
    """Frame rate written as a fraction or a plain number; null when it is neither."""
    parts = F.split(text, "/", 2)
    top = F.get(parts, 0).try_cast("double")
    bottom = F.get(parts, 1)
    return F.when(bottom.isNull(), top).otherwise(F.try_divide(top, bottom.try_cast("double")))


def threshold_tag(grasp: Column, contact: Column) -> Column:
    """Tag of a threshold pair, up to six digits without trailing zeros."""

    def short(value: Column) -> Column:
        digits = F.regexp_replace(F.format_string("%.6g", value), r"(\.\d*?)0+(e|$)", "$1$2")
        return F.regexp_replace(digits, r"\.(e|$)", "$1")

    return F.translate(F.concat(F.lit("grasp_"), short(grasp), F.lit("__contact_"), short(contact)), "-", "m")
