"""Term tagging and the mention map, as native column expressions.

A delimited term matches when a space or the start stands before it and a space, a
comma, a dot, a colon or the end after it, or when it stands alone in parentheses. One
pass finds the first kind: it stops at spaces only and tries the terms as one pattern
with common beginnings factored out, so its cost hardly depends on how many terms there
are. The right edge is looked at but not taken, since it may be the left edge of the
next term.
"""

import re

from pyspark.sql import functions as F

from pulse.functions.terms import DEFAULT_TERMS

MAP_TYPE = "map<string,string>"
_EDGES = [(" ", " "), (" ", ","), (" ", "."), (" ", ":"), ("(", ")")]
_PLAIN_TERM = re.compile(r"[^ ,.:()]+")


def _strings(values):
    """Constant string array from one literal, folded at planning time."""
    if not values:
        return F.array().cast("array<string>")
    return F.split(F.lit("\n".join(values)), "\n")


def _string_map(pairs):
    """Constant string map from one literal, folded at planning time."""
    return F.str_to_map(
        F.lit("\n".join(f"{k}\t{v}" for k, v in pairs)), F.lit("\n"), F.lit("\t")
    )


def _any_of(words):
    """Pattern for any of the words, common beginnings written once."""
    tails = {}
    for word in words:
        tails.setdefault(word[0], []).append(word[1:])
    options = []
    for first, rest in tails.items():
        longer = [r for r in rest if r]
        tail = _any_of(longer) if longer else ""
        optional = f"(?:{tail})?" if longer and len(longer) < len(rest) else tail
        options.append(re.escape(first) + optional)
    return options[0] if len(options) == 1 else f"(?:{'|'.join(options)})"


def _delimited_hits(lowered, words):
    """Terms between delimiters or alone in parentheses; may hold a term twice."""
    word = _any_of(words)
    firsts = "".join(re.escape(c) for c in sorted({w[0] for w in words}))
    spaced = F.regexp_extract_all(
        F.concat(F.lit(" "), lowered),
        F.lit(rf" (?=[{firsts}])({word})(?=[ ,.:]|\z)"),
        F.lit(1),
    )
    enclosed = F.regexp_extract_all(lowered, F.lit(rf"\(({word})\)"), F.lit(1))
    bracket = F.contains(lowered, F.lit("("))
    return F.concat(spaced, F.when(bracket, enclosed).otherwise(_strings([])))


def _found(text, term, needles):
    hit = F.lit(False)
    for needle in needles:
        hit = hit | F.contains(text, F.lit(needle))
    return F.when(hit, F.lit(term.name))


def _bind(value, body):
    """``body(value)`` with ``value`` worked out once, however often the body uses it.

    A filter above a projection is evaluated with the projected expression put in its
    place; an expression that names its input once stays small when that happens.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def _hits(lowered, terms):
    """Matching terms of a lower-cased text, in no particular order."""
    plain = [t.name for t in terms.delimited if _PLAIN_TERM.fullmatch(t.name)]
    # A term holding a delimiter of its own may overlap another: test it literally.
    odd = [t for t in terms.delimited if t.name not in set(plain)]
    padded = F.concat(F.lit(" "), lowered, F.lit(" "))
    literal = [_found(lowered, t, t.needles) for t in terms.substring] + [
        _found(padded, t, [left + t.name + right for left, right in _EDGES]) for t in odd
    ]
    hits = F.array_compact(F.array(*literal)).cast("array<string>")
    return F.concat(_delimited_hits(lowered, plain), hits) if plain else hits


def _in_order(hits, terms):
    """Reading the dictionary against the hits puts them in dictionary order."""
    ordered = F.array_intersect(_strings(terms.names), hits)
    return F.when(F.size(hits) > 1, ordered).otherwise(F.coalesce(hits, _strings([])))


def matched_terms(text, terms=DEFAULT_TERMS):
    """The dictionary terms in a text, in dictionary order, as an array."""
    hits = _bind(F.lower(text), lambda lowered: _hits(lowered, terms))
    return _bind(hits, lambda found: _in_order(found, terms))


def extract_mentions(text, terms=DEFAULT_TERMS):
    """``{term: category}`` for the dictionary terms in a text."""
    if not terms.terms:
        return empty_mentions()
    categories = _string_map((t.name, t.category) for t in terms.terms)
    return _bind(
        matched_terms(text, terms),
        lambda hits: F.map_from_arrays(
            hits, F.transform(hits, lambda t: F.element_at(categories, t))
        ),
    )


def empty_mentions():
    return F.create_map().cast(MAP_TYPE)


def mentions_json(mentions):
    return F.to_json(mentions)


def _last_value_wins(mentions):
    """One entry per key: first place, last value, whatever the session's map policy."""
    names = F.array_distinct(F.map_keys(mentions))
    back_names = F.reverse(F.map_keys(mentions))
    back_values = F.reverse(F.map_values(mentions))
    rebuilt = F.map_from_arrays(
        names,
        F.transform(
            names,
            lambda n: F.element_at(back_values, F.array_position(back_names, n).cast("int")),
        ),
    )
    return F.when(F.size(names) < F.size(mentions), rebuilt).otherwise(mentions)


def parse_mentions(text):
    """Mention map from its JSON text; anything but a JSON object is an empty map."""
    parsed = _bind(F.from_json(text, MAP_TYPE), _last_value_wins)
    return F.coalesce(parsed, empty_mentions())
