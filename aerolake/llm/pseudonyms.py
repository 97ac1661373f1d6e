"""PII: values that pass their check are replaced by keyed pseudonyms of the same format.

Cards, bank accounts, phone and social security numbers, addresses, dates, e-mails and
secrets are found by pattern, checked (check digits, octets, calendar, areas), and run
through a Feistel permutation of all values of their format. Equal values get equal
pseudonyms in every document, different values different ones, and who has the key can
turn them back. No state is shared: each text is treated on its own.
"""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerolake.llm.common import query, table
from aerolake.llm.feistel import permute

# Formats, alphabets, ranges.
FORMS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}@(?:[A-Za-z0-9-]{1,63}\.)+[A-Za-z]{2,24}(?![A-Za-z0-9-])",
    "secret": r"""(?<![A-Za-z0-9])AKIA[0-9A-Z]{16}(?![0-9A-Za-z])
        |(?<![A-Za-z0-9])sk_(?:live|test)_[0-9A-Za-z]{16,}
        |(?i:(?<![A-Za-z0-9])(?:token|password|passwd|secret|api[_-]?key)\b["']?\s{0,3}[=:]\s{0,3}["']?)(?P<hex>[0-9A-Za-z][0-9A-Za-z_-]{11,})""",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?:[ ]?[A-Z0-9]{4}){2,7}(?:[ ]?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "ip": r"(?<![\w.])\d{1,3}(?:\.\d{1,3}){3}(?!\w|\.\d)",
    "date": r"""(?<![\w/.-])(?:\d{4}(?P<ymd>[/-])\d{1,2}(?P=ymd)\d{1,2}(?=T(?:[01]\d|2[0-4]):?[0-5]\d)
        |(?:\d{4}-\d{1,2}-\d{1,2}|\d{1,2}(?P<sep>[/.-])\d{1,2}(?P=sep)\d{4}|\d{4}/\d{1,2}/\d{1,2})(?![\w/-]|\.\d))""",
    "ssn": r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])",
    "card": r"(?<![\w+.-])\d(?:[ -]?\d){12,18}(?![\w-])",
    "phone": r"""(?<![\w+])\+\d{1,3}[ .-]?\(?\d{1,4}\)?(?:[ .-]?\d{2,4}){1,4}(?!\w)
        |(?<![\w(+.-])(?:\(\d{3}\)[ ]?|\d{3}[.-])\d{3}[.-]\d{4}(?![\w-])""",
}
FORM = {kind: re.compile(form, re.X | re.A) for kind, form in FORMS.items()}
PATTERN = re.compile("|".join(FORMS.values()), re.X | re.A)
# Digits behind the country code, the usual number first; without a trunk zero.
PHONE_DIGITS = {
    "1": (10,), "7": (10,), "20": (10, 9), "27": (9,), "30": (10,), "31": (9,), "32": (9, 8), "33": (9,), "34": (9,),
    "36": (9, 8), "39": (10, 9, 11, 8), "40": (9,), "41": (9,), "43": (11, 10, 12, 9, 8, 7), "44": (10, 9), "45": (8,),
    "46": (9, 8, 7), "47": (8,), "48": (9,), "49": (11, 10, 9, 8, 7), "51": (9, 8), "52": (10,), "53": (8,), "54": (11, 10),
    "55": (11, 10), "56": (9,), "57": (10, 8), "58": (10,), "60": (10, 9, 8), "61": (9,), "62": (11, 10, 12, 9), "63": (10, 9),
    "64": (9, 8, 10), "65": (8,), "66": (9, 8), "81": (10, 9), "82": (10, 9, 8), "84": (9, 10), "86": (11, 10), "90": (10,),
    "91": (10,), "92": (10, 9), "93": (9,), "94": (9,), "95": (10, 9, 8), "98": (10,), "212": (9,), "213": (9, 8),
    "216": (8,), "218": (9,), "233": (9,), "234": (10, 8), "251": (9,), "254": (9,), "255": (9,), "256": (9,),
    "351": (9,), "352": (9, 8, 6), "353": (9, 8, 7), "354": (7,), "355": (9, 8), "356": (8,), "357": (8,), "358": (10, 9, 8, 7),
    "359": (9, 8), "370": (8,), "371": (8,), "372": (8, 7), "373": (8,), "374": (8,), "375": (9,), "377": (9, 8), "380": (9,),
    "381": (9, 8), "382": (8,), "385": (9, 8), "386": (8,), "387": (8,), "389": (8,), "420": (9,), "421": (9,), "852": (8,),
    "853": (8,), "855": (9, 8), "880": (10,), "886": (9, 8), "961": (8, 7), "962": (9, 8), "964": (10,), "965": (8,),
    "966": (9,), "968": (8,), "971": (9, 8), "972": (9, 8), "973": (8,), "974": (8,), "977": (10, 8), "992": (9,),
    "994": (9,), "995": (9,), "996": (9,), "998": (9,)}
IBAN_CHARS = {
    country: int(n) for n, countries in {
        15: "NO", 16: "BE", 18: "DK FI FO GL NL SD FK", 19: "MK SI", 20: "AT BA EE KZ LT LU XK MN", 21: "CH HR LI LV",
        22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG DZ",
        25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV",
        29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU"}.items() for country in countries.split()}
PRINTED = re.compile(r"[A-Z]{2}\d{2}(?: [A-Z0-9]{4})+(?: [A-Z0-9]{1,3})?", re.A)
CARD_GROUPS = ((4, 4, 4, 4), (4, 6, 5), (4, 6, 4))
CARD_DIGITS = (16, 15, 14, 13, 19, 18, 17)  # of other groups, in this order
# A text without any of these has nothing to find.
TRIGGER = re.compile(r"[0-9@]|AKIA|sk_|(?i:token|passw|secret|api[_-]?key)")
# Dates of these years stay among themselves, and so do all others.
FIRST_DAY, LAST_DAY = dt.date(1900, 1, 1), dt.date(2099, 12, 31)
DAYS = (LAST_DAY - FIRST_DAY).days + 1
OTHER_DAYS = (dt.date.max - dt.date.min).days + 1 - DAYS
PIECE = 128  # characters of a secret that are permuted together
LOWER, UPPER, DIGITS = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
HEX = "0123456789abcdef"
KINDS = ("email", "secret", "iban", "ip", "date", "ssn", "card", "phone")


def _luhn_ok(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (2 if i % 2 else 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def _iban_rest(text: str) -> int:
    return int("".join(str(int(c, 36)) for c in text[4:] + text[:4])) % 97


def _refill(form: str, chars: str) -> str:
    """``form`` with its letters and digits replaced by ``chars`` in order."""
    fresh = iter(chars)
    return "".join(next(fresh) if c.isalnum() else c for c in form)


def _alphabet(c: str) -> str:
    return DIGITS if c.isdigit() else LOWER if c.islower() else UPPER


def _classes(chars: str, key: bytes, tweak: bytes, back: bool, alphabet: str | None = None,
             valid: Callable[[str], bool] | None = None) -> str:
    """A permutation of all strings with a digit, lower or upper letter where ``chars`` has one."""
    sets = [alphabet or _alphabet(c) for c in chars]
    n = x = 0
    total = 1
    for c, s in zip(chars, sets):
        x, total = x * len(s) + s.index(c), total * len(s)

    def text(number: int) -> str:
        out = []
        for s in reversed(sets):
            number, n = divmod(number, len(s))
            out.append(s[n])
        return "".join(reversed(out))

    shape = tweak + b":" + "".join("9" if s == DIGITS else s[0] for s in sets).encode()
    return text(permute(x, total, key, shape, valid and (lambda number: valid(text(number))), back))


def _email(value: str, key: bytes, back: bool) -> str | None:
    name, _, top = value.rpartition(".")
    chars = "".join(c for c in name if c.isalnum())
    return _refill(name, _classes(chars, key, b"email:" + top.lower().encode(), back)) + "." + top


def _secret(value: str, key: bytes, back: bool) -> str | None:
    """Keys of fixed prefixes; behind a name, hexadecimal digits of one case, or letters and
    digits. Each stays what it is, so it can be turned back."""
    if value.startswith("AKIA") and len(value) == 20:
        return "AKIA" + _classes(value[4:], key, b"akia", back, DIGITS + UPPER)
    if re.match("sk_(?:live|test)_", value):
        return value[:8] + _pieces(value[8:], key, b"sk", back, None, None)
    for alphabet in (HEX, HEX.upper()):
        if set(value) <= set(alphabet):
            # Digits alone count as lower case, so upper case must keep a letter in every piece that has one.
            lettered = (lambda text, was: was.isdigit() == text.isdigit()) if alphabet != HEX else None
            return _pieces(value, key, b"hex", back, alphabet, lettered)
    if not (any(c.isdigit() for c in value) and any(c.isalpha() for c in value)):
        return None
    plain = "".join(c for c in value if c.isalnum())
    mixed = lambda text, _: not (set(text) <= set(HEX) or set(text) <= set(HEX.upper()))
    # With a sign in it, or a letter that is no hexadecimal digit, it is never read as hexadecimal.
    free = len(plain) < len(value) or len(plain) > PIECE
    return _refill(value, _pieces(plain, key, b"word", back, None, None if free else mixed))


def _pieces(chars: str, key: bytes, tweak: bytes, back: bool, alphabet: str | None,
            valid: Callable[[str, str], bool] | None) -> str:
    """``_classes`` of a value of any length, some characters at a time. ``valid`` sees a piece
    and what it was."""
    out = []
    for at in range(0, len(chars), PIECE):
        was = chars[at:at + PIECE]
        number = tweak + (b":%d" % at if at else b"")
        out.append(_classes(was, key, number, back, alphabet, valid and (lambda text, was=was: valid(text, was))))
    return "".join(out)


def _blanks(value: str) -> list[str]:
    """``value`` and what stands before each of its blanks, longest first."""
    ends = [i for i, c in enumerate(value) if c == " "]
    return [value] + [value[:i] for i in reversed(ends)]


def _iban_cuts(value: str) -> tuple[list[str], list[str]]:
    """The prefixes of ``value`` that have their form's fixed length, and the others, in order."""
    fit = IBAN_CHARS.get(value[:2])
    cuts = [(cut, len(cut) - cut.count(" ")) for cut in _blanks(value)]
    return [c for c, n in cuts if n == fit], [c for c, n in cuts if n != fit and 15 <= n <= 34]


def _iban(value: str, key: bytes, back: bool) -> str | None:
    flat = value.replace(" ", "")
    if not 15 <= len(flat) <= 34 or _iban_rest(flat) != 1:
        return None

    def whole(body: str) -> str:
        check = 98 - _iban_rest(flat[:2] + "00" + body)
        return _refill(value, f"{flat[:2]}{check:02d}{body}")

    # What is read whole must not have a part that is tried first and valid.
    first = {len(c) for c in _iban_cuts(value)[0]} - {len(value)}
    ok = lambda body: not any(_iban_rest(whole(body)[:n].replace(" ", "")) == 1 for n in first)
    return whole(_classes(flat[4:], key, b"iban:" + flat[:2].encode(), back, valid=ok if first else None))


def _ip(value: str, key: bytes, back: bool) -> str | None:
    parts = value.split(".")
    if any(len(p) > 1 and p[0] == "0" or int(p) > 255 for p in parts):
        return None
    out = permute(int.from_bytes(bytes(map(int, parts)), "big"), 1 << 32, key, b"ip", back=back)
    return ".".join(map(str, out.to_bytes(4, "big")))


def _date(value: str, key: bytes, back: bool) -> str | None:
    sep = next(c for c in value if not c.isdigit())
    parts = value.split(sep)
    wide = tuple(len(p) for p in parts)

    before = (FIRST_DAY - dt.date.min).days

    def day(y: str, m: str, d: str) -> tuple[bool, int] | None:
        """Whether the date is of the usual years, and its number among those or the others."""
        try:
            found = dt.date(int(y), int(m), int(d))
        except ValueError:
            return None
        if FIRST_DAY <= found <= LAST_DAY:
            return True, (found - FIRST_DAY).days
        number = (found - dt.date.min).days
        return False, number if number < before else number - DAYS

    def at(number: int) -> dt.date:
        if usual:
            return FIRST_DAY + dt.timedelta(number)
        return dt.date.min + dt.timedelta(number if number < before else number + DAYS)

    padded = [len(p) == 2 and p[0] == "0" for p in parts]
    pad = 2 if any(padded) or all(w in (2, 4) for w in wide) else 1
    if wide[0] == 4:
        x, order = day(*parts), "ymd"
    else:
        x, order = day(parts[2], parts[1], parts[0]), "dmy"
        if x is None:
            x, order = day(parts[2], parts[0], parts[1]), "mdy"
    if x is None:
        return None
    usual, x = x
    # Month first is read only where day first fails, and must stay so; a form without
    # leading zeros keeps its numbers of digits.
    digits = (len(str(at(x).day)), len(str(at(x).month))) if pad == 1 else None

    def ok(n: int) -> bool:
        found = at(n)
        return (order != "mdy" or found.day > 12) and (
            digits is None or digits == (len(str(found.day)), len(str(found.month))))

    form = f"date:{order}{sep}{digits}{'' if usual else ':other'}".encode()
    out = at(permute(x, DAYS if usual else OTHER_DAYS, key, form, ok, back))
    fields = {"y": f"{out.year:04d}", "m": f"{out.month:0{pad}d}", "d": f"{out.day:0{pad}d}"}
    return sep.join(fields[c] for c in order)


def _ssn_ok(digits: str) -> bool:
    return (digits[:3] not in ("000", "666") and digits[0] != "9"
            and digits[3:5] != "00" and digits[5:] != "0000")


def _ssn(value: str, key: bytes, back: bool) -> str | None:
    digits = value.replace("-", "")
    return _refill(value, _classes(digits, key, b"ssn", back, valid=_ssn_ok)) if _ssn_ok(digits) else None


def _card_cuts(value: str) -> tuple[list[str], list[str]]:
    """The prefixes of ``value`` in one run or in a card's groups, and the others, in order."""
    fixed, others = [], []
    for cut in _blanks(value):
        groups = tuple(map(len, re.split("[ -]", cut)))
        if 13 <= sum(groups) <= 19:
            (fixed if len(groups) == 1 or groups in CARD_GROUPS else others).append((cut, sum(groups)))
    return [c for c, _ in fixed], [c for c, n in sorted(others, key=lambda x: CARD_DIGITS.index(x[1]))]


def _card(value: str, key: bytes, back: bool) -> str | None:
    digits = "".join(c for c in value if c.isdigit())
    if not 13 <= len(digits) <= 19 or not _luhn_ok(digits) or digits[0] == "0":
        return None

    def whole(middle: str) -> str:
        body = digits[0] + middle
        return body + next(c for c in DIGITS if _luhn_ok(body + c))

    # What is read whole must not have a part that is tried first and valid.
    cuts = [c for found in _card_cuts(value) for c in found]
    first = {sum(c.isdigit() for c in cut) for cut in cuts[:cuts.index(value)]}
    ok = lambda middle: not any(_luhn_ok(whole(middle)[:n]) for n in first)
    tweak = b"card:" + digits[:1].encode()
    return _refill(value, whole(_classes(digits[1:-1], key, tweak, back, valid=ok if first else None)))


def _phone_head(value: str) -> str:
    """The country code with its plus; nothing for a number without one."""
    head = re.match(r"\+\d{1,3}(?=\D)|", value).group()
    if value.startswith("+") and not head:
        head = next((value[:n] for n in (2, 3, 4) if value[1:n] in PHONE_DIGITS), value[:2])
    return head


def _phone_cuts(value: str) -> tuple[list[str], list[str]]:
    """The prefixes of ``value`` that have their country's number of digits, and the others, in order."""
    head, fixed, others = _phone_head(value), [], []
    if not head:
        return [value], []
    usual = PHONE_DIGITS.get(head[1:], ())
    for cut in _blanks(value):
        digits = "".join(c for c in cut[len(head):] if c.isdigit())
        n = len(digits) - (digits[:1] == "0" and len(digits) not in usual)
        if n in usual:
            fixed.append((usual.index(n), cut))
        else:
            others.append(cut)
    return [c for _, c in sorted(fixed, key=lambda x: x[0])], others


def _phone(value: str, key: bytes, back: bool) -> str | None:
    head = _phone_head(value)
    rest = "".join(c for c in value[len(head):] if c.isdigit())
    # A code that nothing parts from its number counts with it.
    parted = not value[len(head):len(head) + 1].isdigit()
    if not (6 <= len(rest) if parted else 6 <= len(rest) + len(head) - 2) or len(rest) + (0 if parted else len(head) - 2) > 14:
        return None
    zero = rest[0] == "0"
    out = _classes(rest, key, b"phone:" + head.encode(), back, valid=lambda x: (x[0] == "0") == zero)
    return head + _refill(value[len(head):], out)


CHANGE = {"email": _email, "secret": _secret, "iban": _iban, "ip": _ip, "date": _date, "ssn": _ssn,
          "card": _card, "phone": _phone}


# Kinds whose form does not say where a value ends: a blank may be within it or behind it.
CUTS = {"iban": _iban_cuts, "card": _card_cuts, "phone": _phone_cuts}


def _values(text: str, at: int) -> tuple[list[tuple[str, int, str]], list[tuple[str, int, str]]]:
    """``(kind, start, value)`` that may begin at ``at``: those of fixed length, and the others."""
    fixed, others = [], []
    for kind, form in FORM.items():
        if match := form.match(text, at):
            if kind in CUTS:
                for found, cuts in zip((fixed, others), CUTS[kind](match.group())):
                    found += [(kind, at, cut) for cut in cuts]
            else:
                fixed.append((kind, match.start("hex"), match["hex"]) if kind == "secret" and match["hex"]
                             else (kind, at, match.group()))
    return fixed, others


def _holds_another(text: str, kind: str, start: int, value: str, key: bytes) -> bool:
    """Whether a value of fixed length begins behind a blank of ``value``."""
    for i, c in enumerate(value):
        if c == " " and (kind != "phone" or sum(x.isdigit() for x in value[len(_phone_head(value)):i]) >= 6):
            if any(CHANGE[k](v, key, False) for k, _, v in _values(text, start + i + 1)[0]):
                return True
    return False


def pseudonymise(text: str | None, key: bytes, back: bool = False) -> tuple[str | None, dict[str, int]]:
    """The text with every valid value replaced (or turned back), and how many of each kind.

    A null text stays null. What fails its check stays as it is; its shorter parts up to a
    blank, other kinds and later starts within it are tried before it is left. Lengths
    that the form fixes (by country, by a card's groups) go before all others, so
    neighbours one blank apart are not taken for a part of a value.
    """
    found: dict[str, int] = {}
    if not text or not TRIGGER.search(text):
        return text, found
    out, done, barred, match = [], 0, 0, PATTERN.search(text)
    while match:
        at = match.start()
        fixed, others = _values(text, at)
        for i, (kind, start, value) in enumerate(fixed + others):
            new = None if kind == "card" and at < barred else CHANGE[kind](value, key, back)
            if new is not None and (i < len(fixed) or not _holds_another(text, kind, start, value, key)):
                out += [text[done:start], new]
                done = at = start + len(value)
                found[kind] = found.get(kind, 0) + 1
                break
        else:
            # Groups of a printed account number with a wrong check are no card.
            barred = max([barred] + [at + len(v) for kind, _, v in fixed if kind == "iban" and PRINTED.fullmatch(v)])
            at += 1
        match = PATTERN.search(text, at)
    return "".join(out) + text[done:], found


def pseudonymise_texts(key: bytes, back: bool = False):
    """A column function from texts to ``(text, n_email, ..., n_phone)``."""

    @F.pandas_udf("text string, " + ", ".join(f"n_{k} long" for k in KINDS))
    def change(texts: pd.Series) -> pd.DataFrame:
        done = [pseudonymise(text, key, back) for text in texts]
        return pd.DataFrame({"text": pd.Series([t for t, _ in done], dtype=object)} | {
            f"n_{k}": pd.Series([n.get(k, 0) for _, n in done], dtype="int64") for k in KINDS})

    return change


def pii_report(docs: DataFrame, key: bytes) -> DataFrame:
    """``doc_id, text, n_values`` and a count per kind, a row for every row of ``docs``.

    Reads ``doc_id, text``; other columns are not read. Null texts stay null, empty ones
    empty; equal texts give equal texts; an empty table gives an empty result.
    """
    rows = docs.select("doc_id", pseudonymise_texts(key)(F.col("text")).alias("r")).select("doc_id", "r.*")
    return rows.withColumn("n_values", sum((F.col(f"n_{k}") for k in KINDS[1:]), F.col(f"n_{KINDS[0]}")))


def hide_pii(docs: DataFrame, key: bytes) -> DataFrame:
    """``docs`` with pseudonyms in ``text``; all columns, in their order."""
    text = pseudonymise_texts(key)(F.col("text"))["text"]
    return docs.select(*[text.alias("text") if c == "text" else F.col(c) for c in docs.columns])


# The key that the registered query uses; a real one comes from a secret store.
QUERY_KEY = b"aerolake test key"


@query("op6_feistel_pseudonyms")
def op6_feistel_pseudonyms(spark, sf):
    return pii_report(table(spark, sf, "documents"), QUERY_KEY)
