"""Format-preserving pseudonyms for personal data, in DataFrame functions only.

Found values are checked first (Luhn for cards, octet range, calendar, IBAN
mod 97, area rules of phone and social-security numbers) and only valid ones
are replaced. A keyed Feistel network then permutes a value within its format:

* character values (cards, phones, account numbers, mail names, keys): the two
  halves of the value are shifted by keyed hashes of each other, every
  character inside its own class, so the shape stays and valid stays valid
  (Luhn and IBAN check digits are worked out anew);
* numeric values (addresses: 2^16 x 2^16; dates: 627 x 233 days, exactly the
  400 years from 1800; social-security numbers): halves as residues.

Both are bijections of the format for a key, so equal values get equal
pseudonyms in every document and different ones stay different. Separators are
no part of the value: a card number links whatever its spacing.

Defined results: null text stays null and has no counts; values that fail
their check stay as they are; all rows and all columns are kept, and a column
that has one of the added names is replaced by it; an empty table gives an
empty result.

Scale: one narrow map over the rows — no shuffle, no broadcast, nothing
collected; only texts that match the pattern are rebuilt."""

from __future__ import annotations

import secrets

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

KEY_CONF = "spark.daycast.pseudonym.key"
ROUNDS = 6

# The patterns of the kinds, in order of preference at one place.
_OCTET = "(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
# By fours: countries whose numbers end in a full group, the others in a short one.
_GROUPED = "|".join([*(f"(?:{c})[0-9]{{2}}(?: [0-9A-Z]{{4}}){{{n}}}" for n, c in (
    (3, "BE"), (4, "AT|BA|EE|KZ|LT|LU|XK"), (5, "AD|CZ|ES|MD|PK|RO|SA|SE|SK|TN|VG"), (6, "AL|AZ|BY|CY|DO|GT|HU|LB|PL|SV"), (7, "LC"))),
    "[A-Z]{2}[0-9]{2}(?: [0-9A-Z]{4}){2,7} [0-9A-Z]{1,3}"])
_COUNTRY = r"(?:\+1[ .-]?|1[ .-])"
_PHONE = (rf"(?:{_COUNTRY}(?:\([0-9]{{3}}\) ?|[0-9]{{3}}[ .-])|(?:\+?1[ .-]?)?(?:\([2-9][0-9]{{2}}\) ?|[2-9][0-9]{{2}}[ .-]))"
          "[2-9][0-9]{2}[ .-][0-9]{4}")
PATTERNS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9][A-Za-z0-9._%+-]*@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}",
    "secret": r"(?<![A-Za-z0-9])(?:AKIA[0-9A-Z]{16}(?![0-9A-Za-z])|[Pp]assword ?[=:] ?[0-9a-zA-Z]{6,}|(?<=[\"'])(?:[0-9a-f]{32,64}|[0-9A-F]{32,64})(?=[\"']))",
    "iban": rf"(?<![A-Za-z0-9])(?:[A-Z]{{2}}[0-9]{{2}}[0-9A-Z]{{11,30}}|{_GROUPED})(?![A-Za-z0-9])",
    "ip": rf"(?<![0-9.])(?:{_OCTET}\.){{3}}{_OCTET}(?![0-9]|\.[0-9])",
    "date": r"(?<![0-9A-Za-z./-])(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{2}[./][0-9]{2}[./][0-9]{4})(?![0-9A-Za-z/-]|\.[0-9])",
    "ssn": r"(?<![0-9A-Za-z-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z-])",
    "phone": rf"(?<![0-9A-Za-z]){_PHONE}(?![0-9A-Za-z])",
    "card": r"(?<![0-9A-Za-z])(?:[0-9]{13,19}|[0-9]{4}([ -])[0-9]{4}\1[0-9]{4}\1[0-9]{4}|[0-9]{4}([ -])[0-9]{6}\2[0-9]{5})(?![0-9A-Za-z])",
}
KINDS = list(PATTERNS)
PATTERN = "|".join(PATTERNS[k] for k in KINDS)
# Character classes of the masks; x stays as it is.
CLASSES = {"d": "0123456789", "n": "23456789", "l": "abcdefghijklmnopqrstuvwxyz",
           "u": "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "h": "0123456789abcdef", "H": "0123456789ABCDEF", "b": "01"}
DAY_MODULI = (627, 233)  # their product is the days of 400 years
FIRST_DAY, YEARS = "1800-01-01", (1800, 2199)


def _q(s: str) -> str:
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def feistel_chars(value: str, mask: str, salt: str, key: str) -> str:
    """SQL of the permuted string: ``mask`` names the class of every character."""
    cases = " ".join(f"WHEN '{m}' THEN {_q(a)}" for m, a in CLASSES.items())
    n = f"length({value})"
    cut = f"CAST(floor({n} / 2) AS INT)"
    part = lambda s, first: (f"filter(split(substr({s}, 1, {cut}), ''), c -> c <> '')" if first
                             else f"filter(split(substr({s}, {cut} + 1), ''), c -> c <> '')")
    stream = f"sha2(concat_ws('|', {_q(key)}, {_q(salt)}, r, CAST(floor(i / 32) AS INT), array_join(s.b, '')), 256)"
    byte = f"CAST(conv(substr({stream}, CAST(i % 32 AS INT) * 2 + 1, 2), 16, 10) AS INT)"
    alphabet = f"(CASE s.ma[i] {cases} ELSE c END)"
    shift = f"substr({alphabet}, (instr({alphabet}, c) - 1 + {byte}) % length({alphabet}) + 1, 1)"
    return (f"aggregate(sequence(1, {ROUNDS}), named_struct('a', {part(value, True)}, 'b', {part(value, False)}, "
            f"'ma', {part(mask, True)}, 'mb', {part(mask, False)}), "
            f"(s, r) -> named_struct('a', s.b, 'b', transform(s.a, (c, i) -> {shift}), 'ma', s.mb, 'mb', s.ma), "
            f"s -> concat(array_join(s.a, ''), array_join(s.b, '')))")


def feistel_int(value: str, moduli: tuple[int, int], salt: str, key: str) -> str:
    """SQL of the permuted number of ``range(m1 * m2)``."""
    m1, m2 = moduli
    f = f"CAST(conv(substr(sha2(concat_ws('|', {_q(key)}, {_q(salt)}, r, s.b), 256), 1, 15), 16, 10) AS BIGINT)"
    return (f"aggregate(sequence(1, {ROUNDS}), named_struct('a', CAST(floor({value} / {m2}) AS BIGINT), 'b', CAST({value} % {m2} AS BIGINT), "
            f"'m', CAST({m1} AS BIGINT), 'n', CAST({m2} AS BIGINT)), "
            f"(s, r) -> named_struct('a', s.b, 'b', (s.a + {f}) % s.m, 'm', s.n, 'n', s.m), s -> s.a * {m2} + s.b)")


def _digits(v: str) -> str:
    return f"regexp_replace({v}, '[^0-9]', '')"


def _luhn(digits: str, doubled: int) -> str:
    """Luhn sum; ``doubled``: parity (from the right) of the doubled places."""
    return (f"aggregate(transform(filter(split(reverse({digits}), ''), c -> c <> ''), (c, i) -> CASE WHEN i % 2 = {doubled} "
            "THEN CAST(c AS INT) * 2 - IF(CAST(c AS INT) > 4, 9, 0) ELSE CAST(c AS INT) END), 0, (x, y) -> x + y)")


def _reformat(v: str, digits: str) -> str:
    """The digits set into the digit places of ``v``."""
    return (f"array_join(transform(filter(split({v}, ''), c -> c <> ''), (c, i) -> CASE WHEN c RLIKE '[0-9]' THEN "
            f"substr({digits}, length({_digits(f'substr({v}, 1, i)')}) + 1, 1) ELSE c END), '')")


def _let(name: str, value: str, body: str) -> str:
    """Bind a value once inside an expression."""
    return f"transform(array({value}), {name} -> {body})[0]"


def _mask(v: str) -> str:
    return (f"regexp_replace(regexp_replace(regexp_replace(regexp_replace({v}, '[^0-9A-Za-z]', '.'), '[0-9]', '0'), '[a-z]', 'l'), '[A-Z]', 'u')")


def _plain(v: str) -> str:
    """Class mask of a string: digits, lower and upper case; the rest stays."""
    return f"translate({_mask(v)}, '0.', 'dx')"


def _date(v: str, key: str) -> str:
    iso = f"{v} RLIKE '^[0-9]{{4}}-'"
    sep = f"substr({v}, 3, 1)"
    # the permuted format keeps the separators, which must agree
    day = f"CASE WHEN {iso} THEN try_to_date({v}, 'yyyy-MM-dd') WHEN substr({v}, 6, 1) = {sep} THEN try_to_date(translate({v}, './', '--'), 'dd-MM-yyyy') END"
    number = "CAST(datediff(d, DATE'" + FIRST_DAY + "') AS BIGINT)"
    new = f"date_add(DATE'{FIRST_DAY}', CAST({feistel_int(number, DAY_MODULI, 'date', key)} AS INT))"
    out = f"CASE WHEN {iso} THEN date_format(e, 'yyyy-MM-dd') ELSE translate(date_format(e, 'dd-MM-yyyy'), '-', {sep}) END"
    inside = f"d BETWEEN DATE'{YEARS[0]}-01-01' AND DATE'{YEARS[1]}-12-31'"
    return _let("d", day, f"CASE WHEN {inside} THEN {_let('e', new, out)} END")


def _kinds(v: str, key: str) -> dict[str, str]:
    """SQL of each kind's pseudonym; NULL where the value fails its check."""
    local = f"substr({v}, 1, instr({v}, '@') - 1)"
    out = {"email": f"concat({feistel_chars(local, _plain(local), 'email', key)}, substr({v}, instr({v}, '@')))"}

    head = f"regexp_extract({v}, '^(AKIA|[Pp]assword ?[=:] ?)?', 0)"
    body = f"substr({v}, length({head}) + 1)"
    hexes = f"{body} RLIKE '^[0-9a-f]*$'"
    upper = f"length({head}) = 0 AND {body} RLIKE '^[0-9A-F]*$'"
    mask = f"CASE WHEN {hexes} THEN repeat('h', length({body})) WHEN {upper} THEN repeat('H', length({body})) ELSE {_plain(body)} END"
    out["secret"] = f"concat({head}, {feistel_chars(body, mask, 'secret', key)})"

    # spaces are no part of the value; letters count as 10 to 35
    mod = lambda x: (f"aggregate(filter(split({x}, ''), c -> c <> ''), 0, (m, c) -> "  # noqa: E731
                     "(m * IF(c RLIKE '[A-Z]', 100, 10) + IF(c RLIKE '[A-Z]', ascii(c) - 55, CAST(c AS INT))) % 97)")
    account, country = "substr(o, 5)", "substr(o, 1, 2)"
    new = feistel_chars(account, _plain(account), "iban", key)
    check = f"lpad(CAST(98 - {mod(f'concat(a, {country}, {_q('00')})')} AS STRING), 2, '0')"
    placed = (f"array_join(transform(filter(split({v}, ''), c -> c <> ''), (c, i) -> IF(c = ' ', c, "
              f"substr(p, length(replace(substr({v}, 1, i), ' ', '')) + 1, 1))), '')")
    valid = f"{mod(f'concat({account}, substr(o, 1, 4))')} = 1"
    out["iban"] = _let("o", f"replace({v}, ' ', '')", f"CASE WHEN {valid} THEN "
                       f"{_let('a', new, _let('p', f'concat({country}, {check}, a)', placed))} END")

    octets = [f"CAST(split_part({v}, '.', {i}) AS BIGINT)" for i in (1, 2, 3, 4)]
    number = f"({octets[0]} * 16777216 + {octets[1]} * 65536 + {octets[2]} * 256 + {octets[3]})"
    new = feistel_int(number, (65536, 65536), "ip", key)
    out["ip"] = _let("p", new, "concat_ws('.', shiftright(p, 24), shiftright(p, 16) & 255, shiftright(p, 8) & 255, p & 255)")

    out["date"] = _date(v, key)

    area, group, serial = (f"CAST(split_part({v}, '-', {i}) AS BIGINT)" for i in (1, 2, 3))
    valid = f"{area} BETWEEN 1 AND 899 AND {area} <> 666 AND {group} > 0 AND {serial} > 0"
    number = f"((({area} - 1 - IF({area} > 666, 1, 0)) * 99 + {group} - 1) * 9999 + {serial} - 1)"
    new = feistel_int(number, (898 * 99, 9999), "ssn", key)
    back = ("CAST(floor(p / 989901) AS BIGINT) + 1 + IF(floor(p / 989901) + 1 > 665, 1, 0)",
            "CAST(floor(p / 9999) AS BIGINT) % 99 + 1", "p % 9999 + 1")
    pads = ", ".join(f"lpad(CAST({b} AS STRING), {n}, '0')" for b, n in zip(back, (3, 2, 4)))
    out["ssn"] = f"CASE WHEN {valid} THEN {_let('p', new, f'concat_ws({_q('-')}, {pads})')} END"

    ten = f"substr({_digits(v)}, -10)"
    # area codes from 0 or 1 stay among themselves, so a number links with and without its country code
    new = feistel_chars(ten, f"IF({ten} RLIKE '^[01]', 'bddndddddd', 'nddndddddd')", "phone", key)
    out["phone"] = _let("p", f"concat(substr({_digits(v)}, 1, length({_digits(v)}) - 10), {new})", _reformat(v, "p"))

    d = _digits(v)
    payload = f"substr({d}, 2, length({d}) - 2)"  # between the first digit, which names the issuer's industry, and the check digit
    new = f"concat(substr({d}, 1, 1), {feistel_chars(payload, f'repeat({_q('d')}, length({payload}))', 'card', key)})"
    check = f"CAST((10 - {_luhn('p', 0)} % 10) % 10 AS STRING)"
    out["card"] = (f"CASE WHEN {_luhn(d, 1)} % 10 = 0 AND NOT {d} RLIKE '^0+$' THEN "
                   f"{_let('p', new, _let('q', f'concat(p, {check})', _reformat(v, 'q')))} END")
    return out


def _replaced(key: str) -> str:
    """SQL over lambda variable ``v`` (a found value): struct of kind and the
    pseudonym, both NULL for a value that fails its check."""
    how = _kinds("v", key)
    whole = {k: PATTERNS[k] for k in KINDS}
    # kinds are told apart by their own shapes; look-arounds do not matter here
    tests = {"email": "v LIKE '%@%'", "secret": "v RLIKE '^(AKIA|[Pp]assword)|^[0-9a-f]{32,64}$|^[0-9A-F]{32,64}$'", "iban": "v RLIKE '^[A-Z]{2}[0-9]'",
             "ip": "v RLIKE '^([0-9]{1,3}[.]){3}[0-9]{1,3}$'", "date": "v RLIKE '^([0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{2}[./][0-9]{2}[./][0-9]{4})$'",
             "ssn": "v RLIKE '^[0-9]{3}-[0-9]{2}-[0-9]{4}$'", "phone": f"v RLIKE {_q(f'^{_PHONE}$')}"}
    kind = "CASE " + " ".join(f"WHEN {tests[k]} THEN '{k}'" for k in whole if k in tests) + " ELSE 'card' END"
    new = "CASE k " + " ".join(f"WHEN '{k}' THEN {how[k]}" for k in whole) + " END"
    return _let("k", kind, _let("w", new, "named_struct('kind', IF(w IS NULL, NULL, k), 'value', coalesce(w, v))"))


def session_key(spark: SparkSession) -> str:
    """The deployment's secret, from the session setting ``KEY_CONF``. Where it is
    unset a random one is drawn and kept for the session: pseudonyms then agree
    within it and cannot be undone by anyone who knows the source."""
    key = spark.conf.get(KEY_CONF, None)
    if not key:
        key = secrets.token_hex(12)
        spark.conf.set(KEY_CONF, key)
    return key


def pseudonymise(docs: DataFrame, key: str | None = None, column: str = "text") -> DataFrame:
    """``docs`` with the text's valid values replaced, ``pii_count`` (replaced
    values) and ``pii_kinds`` (sorted, distinct). ``key``: the session's unless given."""
    key = key or session_key(docs.sparkSession)
    pattern = _q(PATTERN)
    text = f"`{column}`"
    found = "_pii"
    while found in docs.columns:
        found += "_"
    hits = f"CASE WHEN {text} RLIKE {pattern} THEN regexp_extract_all({text}, {pattern}, 0) ELSE CAST(array() AS ARRAY<STRING>) END"
    named = docs.withColumn(found, F.expr(f"transform({hits}, v -> {_replaced(key)})"))
    gaps = f"split({text}, {pattern}, -1)"
    rebuilt = f"array_join(transform(g, (t, i) -> concat(t, coalesce(get({found}, i).value, ''))), '')"
    new = f"CASE WHEN exists({found}, x -> x.kind IS NOT NULL) THEN {_let('g', gaps, rebuilt)} ELSE {text} END"
    kinds = f"filter(transform({found}, x -> x.kind), k -> k IS NOT NULL)"
    return (named.withColumn(column, F.expr(new))
            .withColumn("pii_count", F.expr(f"CAST(size({kinds}) AS INT)"))
            .withColumn("pii_kinds", F.expr(f"array_join(array_sort(array_distinct({kinds})), ',')"))
            .drop(found))
