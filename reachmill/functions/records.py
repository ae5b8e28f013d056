"""JSON texts that may hold more than one record."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# a text that a parser for one object would not read to its end: it opens with a list, one
# value follows another without a comma, or something other than the object's end comes last
_UNUSUAL = r"^\s*\[|[}\]]\s*+[{\[]|[^\s}]\s*$"
# from the end of the last match up to a value that another follows; what is in quotes is
# passed over as a whole. All repeats are possessive: one pass, whatever the length.
_NEXT_VALUE = (
    r'\G((?s:[^"}\]]++|"(?:[^"\\]++|\\.)*+"|[}\]](?!\s*+[{\[]))*+)([}\]])\s*+(?=[{\[])'
)

_END = "end of the text"


def records(text: Column) -> Column:
    """The records of a text, in order, as structs of `text` and `broken`.

    A text is one object, a list of objects, or several of these one after the other,
    with or without line breaks between them. One that is none of that is a single
    broken record, so nothing is passed over. An empty list is broken too.
    """
    joined = F.concat(F.regexp_replace(text, _NEXT_VALUE, "$1$2,"), F.lit(f',"{_END}"]'))
    listed = _elements(F.concat(F.lit("["), joined))
    # a bracket too many ends the list before its last element
    listed = F.when(F.get(listed, F.size(listed) - 1) == _END, F.slice(listed, 1, F.size(listed) - 1))
    values = F.flatten(
        F.transform(listed, lambda v: F.when(v.rlike(r"^\["), _elements(v)).otherwise(F.array(v)))
    )
    whole = F.transform(values, lambda v: F.struct(v.alias("text"), F.lit(False).alias("broken")))
    broken = F.array(F.struct(text.alias("text"), F.lit(True).alias("broken")))
    single = F.array(F.struct(text.alias("text"), F.lit(False).alias("broken")))
    several = F.when(F.size(values) > 0, whole).otherwise(broken)
    return F.when(text.rlike(_UNUSUAL), several).otherwise(single)


def _elements(text: Column) -> Column:
    """The texts of a list's elements; null if it is no valid list."""
    return F.from_json(text, "array<string>")
