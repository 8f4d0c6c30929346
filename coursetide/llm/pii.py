"""Personal data and secrets replaced by format-preserving Feistel pseudonyms.

A Feistel network cuts a value in two and, round by round, shifts one half by a keyed hash of the other.
That is a permutation whatever the hash is, so within a kind different values stay different, equal ones
stay equal in all documents, and whoever holds the key can undo it. Halves are shifted within their
format: digits by digits, letters by letters of their case, other signs not at all.

| kind | taken if | permuted |
| --- | --- | --- |
| card | 13 to 19 digits with a right Luhn digit, up to a separator if other digits follow | all digits but the first; new check digit |
| iban | as long as its country has them, with right check digits (mod 97) | account part; new check digits |
| ssn | area, group and serial that can be issued | among those |
| phone | international with 8 to 15 digits, or ten digits grouped 3-3-4 by hyphens, points or spaces | digits behind the country code |
| ip | four numbers up to 255 | among all addresses |
| date | a day from 1900 to 2099, as y-m-d, d.m.y, d/m/y or else m/d/y | among those days |
| email | | the part before the sign, alike in either case |
| secret | AKIA keys; values after password, token, secret or api key | the value |

Numbers that fail their test stay as they are. Separators stay in their places and don't enter the
permutation, so a number written with and without them keeps one pseudonym. A permutation can map a value to
itself, as rarely as its format has values. Everything is SQL functions: no shuffle, no Python. A null text
stays null, an empty one empty; a text of any length is taken whole; rows, ties and other columns are untouched.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ROUNDS = 8

# The forms in which the kinds are written.
_EMAIL = r"[\p{L}\p{N}._%+-]{1,64}+@(?:[A-Za-z0-9-]{1,63}\.){1,8}[A-Za-z]{2,24}"
_NAMED = r"(?i:password|passwd|pwd|token|secret|api[_-]?key)\s{0,4}[=:]\s{0,4}[\"']?"
_SECRET = r"[A-Za-z0-9+/_-]{8,128}"
_AWS = r"AKIA[A-Z0-9]{16}(?![A-Za-z0-9])"
#: Lengths of IBANs by country.
_IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST",
    26: "IS TR", 27: "FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HU LB PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU",
    31: "MT SC", 32: "LC",
}
_OPEN_IBAN = r"[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?"


def _iban_form() -> str:
    """Each country's length by itself, so that a word or number behind is not taken for a part; then any other country's."""
    forms = []
    for length, countries in _IBAN_LENGTHS.items():
        fours, rest = divmod(length - 4, 4)
        tail = f" ?[A-Z0-9]{{{rest}}}" if rest else ""
        forms.append(rf"(?:{'|'.join(countries.split())})\d\d(?: ?[A-Z0-9]{{4}}){{{fours}}}{tail}")
    known = "|".join(" ".join(_IBAN_LENGTHS.values()).split())
    return rf"(?=[A-Z]{{2}}\d\d)(?:(?:{'|'.join(forms)})(?![A-Za-z0-9])|(?!{known}){_OPEN_IBAN}(?![A-Za-z0-9]))"


_IBAN = _iban_form()
_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
_IP = rf"(?:{_OCTET}\.){{3}}{_OCTET}(?!\.?\d)"
_ISO = r"(?:19|20)\d\d-\d\d-\d\d(?!-?\d)"
_DOTTED = r"\d{1,2}\.\d{1,2}\.(?:19|20)\d\d(?!\.?\d)"
_SLASHED = r"\d{1,2}/\d{1,2}/(?:19|20)\d\d(?!/?\d)"
_SSN = r"\d{3}-\d{2}-\d{4}(?!-?\d)"
_ABROAD = r"\+\d{1,3}[ .-]?(?:\(\d{1,4}\)|\d{1,4})(?:[ .-]?\d{2,4}){1,4}(?!\d)"
_HOME = r"(?:\(\d{3}\) ?|\d{3}[-. ])\d{3}[-. ]\d{4}(?!\d)"
#: Country codes of two digits; those that begin with 1 or 7 have one, all others three.
_CODES = "20 27 3[0-4] 36 39 4[013-9] 5[1-8] 6[0-6] 8[1246] 9[0-58]".replace(" ", "|")
#: Up to 19 digits if no others follow; else groups and runs as cards are written, whatever follows them.
_CARD = "|".join((
    r"\d(?:[ -]?\d){12,18}(?![ -]?\d|[./]\d)", r"\d{4}(?:[ -]\d{4}){3}[ -]\d{3}(?!\d|[-./]\d)", r"\d{4}(?:[ -]\d{4}){3}(?!\d)",
    r"\d{4}[ -]\d{6}[ -]\d{5}(?!\d)", r"\d{13,19}(?!\d)",
))
_FIRST_DAY, _DAYS = "1900-01-01", 73049
PATTERN = r"(?<![\p{L}\p{N}_])(?:" + "|".join(
    (_EMAIL, _NAMED + _SECRET, _AWS, _IBAN, _IP, _ISO, _DOTTED, _SLASHED, _SSN, _ABROAD, _HOME, _CARD)
) + ")"


def _q(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _like(form: str) -> str:
    return f"m rlike {_q('^(?:' + form + ')$')}"


def _only(signs: str, value: str = "m") -> str:
    return f"regexp_replace({value}, {_q('[^' + signs + ']')}, '')"


class _Key:
    """SQL of permutations under one key; ``back`` undoes them."""

    def __init__(self, key: str, back: bool):
        self.key, self.sign = _q(key), "-" if back else "+"
        self.rounds = f"sequence({ROUNDS - 1}, 0, -1)" if back else f"sequence(0, {ROUNDS - 1})"

    def _hash(self, kind: str, *parts: str) -> str:
        return f"sha2(concat_ws('|', {self.key}, '{kind}', r, {', '.join(parts)}), 256)"

    def _shifted(self, part: str, other: str, kind: str, letters: str) -> str:
        """``letters``: how many letters of the alphabet there are."""
        digest = self._hash(kind, other, "(i - 1) div 32")
        step = f"cast(conv(substr({digest}, 2 * ((i - 1) % 32) + 1, 2), 16, 10) as int)"

        def within(first: str, n: str) -> str:
            return f"char(ascii('{first}') + pmod(ascii(c) - ascii('{first}') {self.sign} {step}, {n}))"

        signs = (
            f"case when c between '0' and '9' then {within('0', '10')} "
            f"when c between 'a' and 'z' then {within('a', letters)} "
            f"when c between 'A' and 'Z' then {within('A', '26')} else c end"
        )
        return (
            f"if({part} = '', '', array_join(transform(split({part}, ''), "
            f"(c, j) -> transform(array(j + 1), i -> {signs})[0]), ''))"
        )

    def text(self, value: str, kind: str, letters: str = "26") -> str:
        halves = f"named_struct('l', substr({value}, 1, length({value}) div 2), 'r', substr({value}, length({value}) div 2 + 1))"
        left = self._shifted("x.l", "x.r", kind, letters)
        right = self._shifted("x.r", "x.l", kind, letters)
        return (
            f"aggregate({self.rounds}, {halves}, (x, r) -> if(r % 2 = 0, named_struct('l', {left}, 'r', x.r), "
            f"named_struct('l', x.l, 'r', {right})), x -> concat(x.l, x.r))"
        )

    def pair(self, x: str, y: str, kind: str, a: int, b: int, into: str) -> str:
        """Permutes pairs of ``x`` below ``a`` and ``y`` below ``b``; ``into`` has the new s.x and s.y."""

        def step(own: str, other: str, n: int) -> str:
            number = f"cast(conv(substr({self._hash(kind, other)}, 1, 12), 16, 10) as bigint)"
            return f"pmod({own} {self.sign} {number}, {n}L)"

        return (
            f"aggregate({self.rounds}, named_struct('x', cast({x} as bigint), 'y', cast({y} as bigint)), "
            f"(s, r) -> if(r % 2 = 0, named_struct('x', {step('s.x', 's.y', a)}, 'y', s.y), "
            f"named_struct('x', s.x, 'y', {step('s.y', 's.x', b)})), s -> {into})"
        )


def _let(name: str, value: str, then: str) -> str:
    return f"transform(array({value}), {name} -> {then})[0]"


def _refit(signs: str, chars: str) -> str:
    """The match with its characters of ``signs`` replaced by those of ``chars`` in turn."""
    return (
        f"array_join(transform(split(m, ''), (c, j) -> if(c rlike {_q('[' + signs + ']')}, "
        f"substr({chars}, length({_only(signs, 'substr(m, 1, j + 1)')}), 1), c)), '')"
    )


def _luhn(digits: str) -> str:
    return (
        f"aggregate(transform(split(reverse({digits}), ''), (c, j) -> cast(c as int) * (1 + j % 2) "
        f"- if(j % 2 = 1 and c > '4', 9, 0)), 0, (n, v) -> n + v) % 10"
    )


def _mod97(chars: str) -> str:
    return (
        f"aggregate(split({chars}, ''), 0, (n, c) -> if(c between '0' and '9', n * 10 + cast(c as int), "
        f"n * 100 + ascii(c) - 55) % 97)"
    )


def _pseudonym(k: _Key) -> str:
    """SQL for the pseudonym of the match ``m``, or ``m`` itself if it fails the test of its kind."""
    card = _let("m", "substr(m, 1, i)", _let("d", _only("0-9"), _let(
        "p", f"concat(substr(d, 1, 1), {k.text('substr(d, 2, length(d) - 2)', 'card')})",
        _let("full", f"concat(p, (10 - {_luhn(chr(99) + 'oncat(p, ' + repr('0') + ')')}) % 10)", _refit("0-9", "full")),
    )))
    # the longest part from the start, up to a separator, that has a right check digit
    ends = "filter(sequence(length(m), least(13, length(m)), -1), i -> substr(m, i + 1, 1) in ('', ' ', '-') and substr(m, i, 1) between '0' and '9')"
    right = _let("d", _only("0-9", "substr(m, 1, i)"), f"length(d) >= 13 and {_luhn('d')} = 0")
    card = _let("i", f"get(filter({ends}, i -> {right}), 0)", f"if(i is null, m, concat({card}, substr(m, i + 1)))")
    iban = _let("d", _only("A-Z0-9"), f"if({_mod97('concat(substr(d, 5), substr(d, 1, 4))')} = 1, " + _let(
        "p", k.text("substr(d, 5)", "iban"),
        _let("full", f"concat(substr(d, 1, 2), lpad(cast(98 - {_mod97('concat(p, substr(d, 1, 2), ' + repr('00') + ')')} as string), 2, '0'), p)", _refit("A-Z0-9", "full")),
    ) + ", m)")
    area = "cast(substr(d, 1, 3) as int)"
    ssn = _let("d", _only("0-9"), f"if({area} not in (0, 666) and {area} < 900 and substr(d, 4, 2) <> '00' and substr(d, 6) <> '0000', " + _let(
        "full", k.pair(
            f"{area} - if({area} > 666, 2, 1)",
            "(cast(substr(d, 4, 2) as int) - 1) * 9999 + cast(substr(d, 6) as int) - 1", "ssn", 898, 99 * 9999,
            "concat(lpad(cast(s.x + if(s.x >= 665, 2, 1) as string), 3, '0'), lpad(cast(s.y div 9999 + 1 as string), 2, '0'), lpad(cast(s.y % 9999 + 1 as string), 4, '0'))",
        ), _refit("0-9", "full")) + ", m)")
    abroad = _let("d", _only("0-9"), "if(length(d) between 8 and 15, " + _let(
        "cc", f"case when d rlike '^[17]' then 1 when d rlike '^(?:{_CODES})' then 2 else 3 end",
        _let("full", f"concat(substr(d, 1, cc), {k.text('substr(d, cc + 1)', 'phone')})", _refit("0-9", "full")),
    ) + ", m)")
    home = _let("d", _only("0-9"), _let("full", k.text("d", "phone"), _refit("0-9", "full")))
    octets = "transform(split(m, '[.]'), o -> cast(o as int))"
    ip = _let("o", octets, k.pair(
        "o[0] * 256 + o[1]", "o[2] * 256 + o[3]", "ip", 65536, 65536,
        "concat_ws('.', s.x div 256, s.x % 256, s.y div 256, s.y % 256)"))

    def day(number: str) -> str:
        # 271 * 270 is the first product above the number of days; the few values beyond are permuted again
        again = k.pair("v div 270", "v % 270", "date", 271, 270, "s.x * 270 + s.y")
        return (
            f"date_add(date'{_FIRST_DAY}', cast(aggregate(sequence(1, 16), cast({number} as bigint), "
            f"(v, j) -> if(j > 1 and v < {_DAYS}, v, {again})) as int))"
        )

    def dated(y: str, mo: str, d: str, form: str, otherwise: str) -> str:
        made = f"try_cast(concat_ws('-', {y}, lpad({mo}, 2, '0'), lpad({d}, 2, '0')) as date)"
        return _let("t", made, f"if(t is null, {otherwise}, date_format({day(f'''datediff(t, date'{_FIRST_DAY}')''')}, '{form}'))")

    parts = "split(m, '[./-]')"
    iso = _let("f", parts, dated("f[0]", "f[1]", "f[2]", "yyyy-MM-dd", "m"))
    dotted = _let("f", parts, dated("f[2]", "f[1]", "f[0]", "dd.MM.yyyy", "m"))
    slashed = _let("f", parts, dated("f[2]", "f[1]", "f[0]", "dd/MM/yyyy", dated("f[2]", "f[0]", "f[1]", "MM/dd/yyyy", "m")))
    small, large = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    cased = "transform(split(v, ''), (c, j) -> if(c between 'A' and 'Z', upper(substr(p, j + 1, 1)), substr(p, j + 1, 1)))"
    email = _let("v", "substring_index(m, '@', 1)", _let(
        "p", k.text(f"translate(v, '{large}', '{small}')", "email"), f"concat(array_join({cased}, ''), '@', substring_index(m, '@', -1))"
    ))
    named = _let("n", f"regexp_extract(m, {_q('^' + _NAMED)}, 0)", _let(
        "v", "substr(m, length(n) + 1)",
        f"concat(n, if(v rlike '^[0-9a-f]+$', {k.text('v', 'hex', '6')}, {k.text('v', 'secret')}))"))
    aws = f"concat('AKIA', {k.text('substr(m, 5)', 'aws')})"
    return (
        f"case when {_like(_EMAIL)} then {email} when {_like(_NAMED + _SECRET)} then {named} "
        f"when {_like(_AWS)} then {aws} when {_like(_IBAN)} then {iban} when {_like(_IP)} then {ip} "
        f"when {_like(_ISO)} then {iso} when {_like(_DOTTED)} then {dotted} when {_like(_SLASHED)} then {slashed} "
        f"when {_like(_SSN)} then {ssn} when {_like(_ABROAD)} then {abroad} when {_like(_HOME)} then {home} "
        f"else {card} end"
    )


def pseudonymise(
    docs: DataFrame, key: str, *, text: str = "text", count: str | None = None, back: bool = False
) -> DataFrame:
    """``docs`` with ``text`` rewritten; ``count`` names a column to add, the values that changed.

    ``back`` gives the originals of texts that were rewritten under ``key``, except where a slashed date
    could be read both ways, or where digits behind a new card number happen to make a longer one right.
    """
    taken = set(docs.columns) | {count}
    pieces, found, new = (next(n for i in range(len(taken) + 1) if (n := f"{name}{i}") not in taken) for name in ("pieces", "found", "new"))
    t = f"`{text}`"
    may = f"{t} rlike '[0-9@=:]|AKIA'"
    rows = docs.withColumn(found, F.expr(f"if({may}, regexp_extract_all({t}, {_q(PATTERN)}, 0), array())").cast("array<string>"))
    rows = rows.withColumn(new, F.expr(f"transform({found}, m -> {_pseudonym(_Key(key, back))})"))
    rows = rows.withColumn(pieces, F.expr(f"if(size({found}) = 0, array({t}), split({t}, {_q(PATTERN)}, -1))"))
    changed = F.expr(f"size(filter(zip_with({found}, {new}, (a, b) -> a <> b), d -> d))").cast("long")
    # split leaves one piece more than there are matches
    rewritten = F.expr(f"array_join(zip_with({pieces}, {new}, (p, n) -> concat(p, coalesce(n, ''))), '')")
    columns = [F.when(F.col(text).isNotNull(), rewritten).alias(text) if c == text else F.col(f"`{c}`") for c in docs.columns if c != count]
    return rows.select(*columns, *([changed.alias(count)] if count else []))
