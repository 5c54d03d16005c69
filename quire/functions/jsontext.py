"""Reading JSON texts of unknown quality."""

from __future__ import annotations

import json
import re
from json.decoder import scanstring


def _refuse(name: str):
    raise ValueError(name)


_decode = json.JSONDecoder(parse_constant=_refuse).decode


_SPACE = re.compile(r"[ \t\n\r]*")
_SCALAR = re.compile(r"(?P<word>true|false|null)|(?P<int>-?(?:0|[1-9][0-9]*))(?P<frac>\.[0-9]+)?(?P<exp>[eE][-+]?[0-9]+)?")
_WORDS = {"true": True, "false": False, "null": None}


def _decode_deep(text: str):
    """What the decoder gives, for values nested deeper than it can go: without recursion, but slower."""
    open_: list = []
    keys: list[str] = []
    i = _SPACE.match(text).end()
    while True:
        # a value begins at i
        c = text[i : i + 1]
        if c in ("{", "["):
            value: object = {} if c == "{" else []
            i = _SPACE.match(text, i + 1).end()
            if text[i : i + 1] != ("}" if c == "{" else "]"):
                open_.append(value)
                if c == "{":
                    i = _key(text, i, keys)
                continue
            i += 1
        elif c == '"':
            value, i = scanstring(text, i + 1, True)
        else:
            found = _SCALAR.match(text, i)
            if not found:
                raise ValueError(i)
            i = found.end()
            value = _WORDS[found["word"]] if found["word"] else float(found[0]) if found["frac"] or found["exp"] else int(found[0])
        # the value ends at i, and with it all that end there
        while True:
            i = _SPACE.match(text, i).end()
            if not open_:
                if i < len(text):
                    raise ValueError(i)
                return value
            around = open_[-1]
            if isinstance(around, dict):
                around[keys.pop()] = value
            else:
                around.append(value)
            c = text[i : i + 1]
            if c == ",":
                i = _SPACE.match(text, i + 1).end()
                if isinstance(around, dict):
                    i = _key(text, i, keys)
                break
            if c != ("}" if isinstance(around, dict) else "]"):
                raise ValueError(i)
            value = open_.pop()
            i += 1


def _key(text: str, i: int, keys: list[str]) -> int:
    """Reads a key at ``i``; the place of its value."""
    if text[i : i + 1] != '"':
        raise ValueError(i)
    key, i = scanstring(text, i + 1, True)
    i = _SPACE.match(text, i).end()
    if text[i : i + 1] != ":":
        raise ValueError(i)
    keys.append(key)
    return _SPACE.match(text, i + 1).end()


def read_json(text: str | None):
    """The object or array that a text holds; None if the text is not complete JSON or holds a single value.

    JSON that was encoded twice (a JSON string that holds JSON) counts as its content.
    """
    value = text
    try:
        for _ in range(8):
            if not isinstance(value, str):
                break
            try:
                value = _decode(value)
            except RecursionError:
                value = _decode_deep(value)
    except ValueError:
        return None
    return value if isinstance(value, (dict, list)) else None


def kind_of(value) -> str:
    """string, number, boolean, object, array or null."""
    if value is None:
        return "null"
    if isinstance(value, bool):
        return "boolean"
    return {str: "string", int: "number", float: "number", dict: "object"}.get(type(value), "array")


def as_text(value) -> str | None:
    """A scalar or array as text; strings as they are."""
    return value if isinstance(value, str) or value is None else json.dumps(value, ensure_ascii=False)

# --- records as streams -----------------------------------------------------------------------------------------

#: Kinds of triples: a repeated object begins; a key occurs again in its object.
OPEN, RETRACT = "{", "!"
#: Put behind a field path that two fields of one object share, as "a.b" and "b" within "a".
SAME = "~"

_KEY = re.compile(r'[ \t\n\r]*"([^"\\\x00-\x1f]*)"[ \t\n\r]*:')
#: Groups: 1 plain string, 2 and 3 number, 4 opening, 5 boolean, 6 null, 7 end of an empty array; none: a string with escapes.
_VALUE = re.compile(r'[ \t\n\r]*(?:"([^"\\\x00-\x1f]*)"|(-?(?:0|[1-9][0-9]*))((?:\.[0-9]+)?(?:[eE][-+]?[0-9]+)?)|([\[{])|(true|false)|(null)|(\])|(?="))')
_AFTER = re.compile(r"[ \t\n\r]*([,}\]])")
_FIRST = re.compile(r"[ \t\n\r]*(\}|(?=\"))")
_ORDINAL = re.compile(r"\[[0-9]+\]")
_LONE = re.compile("[\ud800-\udfff]")


def pointer_part(key: str) -> str:
    return key.replace("~", "~0").replace("/", "~1") if "~" in key or "/" in key else key


def _string(text: str, i: int) -> tuple[str, int]:
    """The string with escapes whose opening quote is at ``i``, and the place behind it; lone surrogates become U+FFFD."""
    value, i = scanstring(text, i + 1, True)
    return _LONE.sub("�", value), i


def _escaped_key(text: str, i: int) -> tuple[str, int]:
    m = _FIRST.match(text, i)
    if not m or m.group(1):
        raise ValueError(i)
    key, i = _string(text, m.end())
    i = _SPACE.match(text, i).end()
    if text[i : i + 1] != ":":
        raise ValueError(i)
    return key, i + 1


def _opened(text: str | None) -> tuple[str, re.Match]:
    """The text, freed of encodings as a JSON string, and the match of its first bracket."""
    text = text or ""
    for _ in range(8):
        m = _VALUE.match(text)
        if not m or m.lastindex not in (None, 1):
            break
        content, i = scanstring(text, text.index('"') + 1, True)
        if _SPACE.match(text, i).end() < len(text):
            raise ValueError(i)
        text = content
    if not m or m.lastindex != 4:
        raise ValueError("neither object nor array")
    return text, m


def triples(text: str | None):
    """(table path, owner's place, field path, ordinal, kind, value) of a JSON text, token by token, without its tree.

    The owner is the innermost object that is an element of an array, or the record itself, whose place is ''.  It is
    announced by a triple of kind OPEN with its own place and its parent's place as value, before any of its fields.
    Kinds of values: 's' string, 'i' integer of at most 18 characters, 'n' other number, 'b' boolean, '0' null, 'a' array of scalars (its JSON as
    written), 'o' empty object.  Scalars beside containers in one array are fields by their ordinals.  RETRACT says
    that a key is repeated in its object: what was read under it (field, and its place as value) is void.

    JSON that was encoded twice counts as its content.  Raises ValueError where the text stops being complete JSON
    or if it holds a single value; what was yielded before is then void, too.
    """
    text, m = _opened(text)
    key_at, value_at, after_at, space_at = _KEY.match, _VALUE.match, _AFTER.match, _SPACE.match
    yield "", "", "", None, OPEN, None
    # ``full`` is the path from the top, ``cut`` where the field path within the owner begins, ``place`` the pointer and
    # ``mine`` the length of the owner's; what encloses the present container waits in ``stack`` by its lengths
    full, cut, place, mine = "", 0, "", 0
    is_object, keys, held, n, begin = m.group(4) == "{", set(), [], 0, m.end() - 1
    stack: list[tuple] = []
    i = m.end()
    fresh = True
    table = owner = prefix = ""
    while True:
        kind = None
        if is_object:
            if fresh and (m := _FIRST.match(text, i)) and m.group(1):
                i = m.end()
                if prefix:
                    yield table, owner, prefix[:-1], None, "o", "{}"
                ended = True
            else:
                m = key_at(text, i)
                if m:
                    key, i = m.group(1), m.end()
                else:
                    key, i = _escaped_key(text, i)
                field = prefix + key
                if key in keys:
                    yield table, owner, field, None, RETRACT, f"{place}/{pointer_part(key)}"
                keys.add(key)
                ended = False
        else:
            ended = False
        if not ended:
            m = value_at(text, i)
            if not m:
                raise ValueError(i)
            i, k = m.end(), m.lastindex
            if k == 1:
                kind, value = "s", m.group(1)
            elif k == 3:
                kind, value = ("n" if m.group(3) or m.end() - m.start(2) > 18 else "i", m.group(2) + m.group(3))
            elif k == 4:
                opens_object = m.group(4) == "{"
                stack.append((is_object, len(full), None, cut, len(place), mine, keys, held, n + 1, begin))
                if is_object:
                    full += key + "." if opens_object else key
                    place = f"{place}/{pointer_part(key)}"
                else:
                    if held:
                        for at, kind, value in held:
                            yield table, owner, f"{prefix}[{at}]", at, kind, value
                        held = None
                        stack[-1] = (*stack[-1][:7], None, *stack[-1][8:])
                    elif held is not None:
                        stack[-1] = (*stack[-1][:7], None, *stack[-1][8:])
                    place = f"{place}/{n}"
                    if opens_object:
                        stack[-1] = (*stack[-1][:2], full, *stack[-1][3:])
                        full = _ORDINAL.sub("[]", full) + "[]." if "[" in prefix else full + "[]."
                        cut, parent, mine = len(full), owner, len(place)
                        yield full[:-1], place, "", n, OPEN, parent
                    else:
                        full += f"[{n}]"
                is_object, keys, held, n, begin, fresh = opens_object, set(), [], 0, i - 1, True
                table, owner, prefix = full[: cut - 1] if cut else "", place[:mine], full[cut:]
                continue
            elif k == 5:
                kind, value = "b", m.group(5)
            elif k == 6:
                kind, value = "0", None
            elif k is None:
                kind = "s"
                value, i = _string(text, i)
            elif not is_object and fresh:
                yield table, owner, prefix or "[]", None, "a", "[]"
                ended = True
            else:
                raise ValueError(i)
        if kind is None:
            pass
        elif is_object:
            yield table, owner, field, None, kind, value
        else:
            if held is None:
                yield table, owner, f"{prefix}[{n}]", n, kind, value
            else:
                held.append((n, kind, value))
            n += 1
        # what ends here
        while True:
            if not ended:
                m = after_at(text, i)
                if not m:
                    raise ValueError(i)
                i = m.end()
                c = m.group(1)
                if c == ",":
                    break
                if c != ("}" if is_object else "]"):
                    raise ValueError(i)
                if not is_object and held:
                    yield table, owner, prefix or "[]", None, "a", _LONE.sub("�", text[begin:i])
            ended = False
            if not stack:
                if space_at(text, i).end() < len(text):
                    raise ValueError(i)
                return
            is_object, length, whole, cut, at, mine, keys, held, n, begin = stack.pop()
            full = full[:length] if whole is None else whole
            place = place[:at]
            table, owner, prefix = full[: cut - 1] if cut else "", place[:mine], full[cut:]
        fresh = False
