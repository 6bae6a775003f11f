"""Personal data replaced by surrogates: keyed, of the same type and format, distinct and consistent.

Kinds: e-mail addresses, telephone numbers, payment cards, IPv4 and IPv6 addresses, social-security numbers, IBANs,
secrets (assigned to a name such as token or password, with a known prefix, or of 32 hex digits and more) and names of
persons. A name is a listed given name or a form of address before a capitalised surname, or capitalised words after a label such as
"Name:" or "my name is", in Latin, Cyrillic or Greek script. A name that a document has once is replaced wherever it stands there in
capitals or with a capital first, alone too. Spans have no greatest length: a secret is replaced to its end. What is read before a
value is as long as the longest keyword and any white space; assigned passwords have four characters at least, other secrets six.

A value's surrogate is drawn by HMAC-SHA256 from the key, the kind and the canonical value (digits of a number, lower
case of an address or name), so every mention of it anywhere becomes the same, in the mention's own format: layout of
digits, letter case, script. Given names are permuted, by the key, within the names of their gender and script; surnames are
composed of syllables of their script, with the gendered ending where there is one. Card and IBAN check digits stay
valid where they were and invalid where they were not; private IPv4 addresses stay private, IPv4 octets stay in range;
an e-mail address keeps its top-level domain.

Collision checks: the distinct canonical values of the corpus are gathered, and as long as two values of a kind have
one surrogate or a surrogate is itself a value of the corpus, all but the least such value are drawn anew. The few
values drawn more than once are handed to the second pass over the texts as hashes of 16 bytes: by broadcast up to ``broadcast_rows``
of them (some MB), beyond that by a join on the hash of the text, with the same result. From the ninth draw on a surrogate is longer than
its value, so a domain that is too small can't stop it.

Null texts stay null and empty ones empty; texts without entities come out as they are. Repeated rows get the same
replacements. Other columns are passed through, whatever their names (dots too) and types; an empty table stays empty.
"""

from __future__ import annotations

import bisect
import functools
import hashlib
import hmac
import re
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomwork.columns import col
from loomwork.llm import names
from loomwork.workspace import Workspace

_DOMAIN = re.compile(r"@((?:[^\W_](?:[\w-]*[^\W_])?\.)+[^\W\d_]{2,})(?!\w)")
_NUMBER = re.compile(r"(?:\+ ?|\()?\d")
_DIGITS = re.compile(r"\d+")
_PHONES = [
    re.compile(x + r"(?!\d)(?![.-]\d)")
    for x in (
        r"(?:\+?\d{1,3}[ .-]?)?\(\d{2,5}\)[ .-]?\d{2,4}(?:[ .-]?\d{2,4}){1,2}",
        r"(?:\+?\d{1,3}[ .-])?\d{3}([ .-])\d{3}\1\d{4}",
        r"\+ ?\d{1,3}(?:[ .-]?\d{2,4}){2,4}",
        r"\+ ?\d{8,15}",
        r"00\d{1,3}(?:[ .-]\d{2,4}){2,4}",
        r"0\d{1,4}[ /-]\d{3,4}[ -]?\d{2,4}(?:[ -]?\d{2,4})?",
        r"0\d(?:[ .]\d{2}){4}",
    )
]
_IP4 = re.compile(r"(?:(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)\.){3}(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)(?![\d]|\.\d)")
_SSN = re.compile(r"\d{3}-\d{2}-\d{4}(?![\d-])")
_CARD = re.compile(r"(?:\d{13,19}|\d{4}(?:([ -])\d{4})(?:\1\d{4}){2}(?:\1\d{1,3})?|\d{4}[ -]\d{6}[ -]\d{5})(?![\d])")
_ASSIGN = re.compile(r"[:=]")
_LEAD = re.compile(r"[:=]{1,2}>?[ \t]*(?:Bearer )?")
_QUOTED = re.compile(r"""(["'`])((?:(?!\1)[^\n])*+)\1""")
_BARE = re.compile(r"""[^\s"'`,;<>(){}\[\]]*+""")
_KEYWORD = re.compile(r"(?i)(?:token|secret|passw(?:or)?d|passwd|passphrase|pwd|api[_-]?key|apikey|access[_-]?key|private[_-]?key|auth|credential|client[_-]?id)s?\Z")
_KEYWORD_CHARS = 24  # the longest keyword and more
_KEYWORD_PARTS = ("token", "secret", "passw", "passphrase", "pwd", "key", "auth", "credential", "client")
_PREFIXES = ("AKIA", "ASIA", "ghp_", "gho_", "ghs_", "github_pat_", "sk-", "sk_live_", "pk_live_", "xox", "glpat-", "AIza", "eyJ")
_PREFIXED = re.compile(r"(?<![A-Za-z0-9])(AKIA|ASIA|ghp_|gho_|ghs_|github_pat_|sk-|sk_live_|pk_live_|xox[abprs]-|glpat-|AIza|eyJ)[A-Za-z0-9_.=-]{16,}+")
_KEYBLOCK = re.compile(r"(-----BEGIN [A-Z ]*PRIVATE KEY-----)([A-Za-z0-9+/=\s]+)(-----END [A-Z ]*PRIVATE KEY-----)")
_WORDCHARS_ON = re.compile(r"[A-Za-z0-9]*")
_HEX = re.compile(r"[0-9a-f]{32,}\Z|[0-9A-F]{32,}\Z")
_IBAN = re.compile(r"[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")
_IP6 = re.compile(r"(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])|(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}:){1,6}(?::[0-9A-Fa-f]{1,4}){1,6}(?![0-9A-Fa-f:])")
_CAPS = re.compile(r"[A-ZÀ-ÖØ-ÞΑ-ΫЀ-Я]")
_FIRST = re.compile(r"[^\W\d_]+(?:-[^\W\d_]+)?")
_CAPITALISED = re.compile(r"[A-ZÀ-ÖØ-ÞΑ-ΫЀ-Я][^\W\d_]*")
_LABEL = re.compile(r"(?:\b(?:[Nn]ame|NAME|[Aa]uthor|AUTHOR|[Cc]ontact|CONTACT|[Ss]igned|[Ss]ender|[Pp]atient|[Ee]mployee|[Rr]ecipient|[Aa]ttn)[ \t]*:[ \t]*|\b[Mm]y name is )(?=[^\W\d_])")
_MORE = re.compile(r"(\.?)[ \u00a0]([^\W\d_]+(?:['’-][^\W\d_]+)*)")

Span = tuple[int, int, str, str]  # start, end, kind, canonical value


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def _iban_mod(s: str) -> int:
    return int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97


def _emails(t: str, out: list[Span]) -> None:
    for m in _DOMAIN.finditer(t):
        a = m.start()
        while a and (t[a - 1].isalnum() or t[a - 1] in "_.%+'-"):
            a -= 1
        while a < m.start() and t[a] in ".'-+%":
            a += 1
        if a < m.start():
            out.append((a, m.end(), "email", t[a : m.end()].lower()))


def _assigned(t: str, i: int, password: bool) -> tuple[int, int] | None:
    """The value that the sign at ``i`` assigns: quoted, or up to white space or a mark that ends it. Only passwords may have spaces."""
    at = _LEAD.match(t, i).end()
    if (q := _QUOTED.match(t, at)) and (password or not re.search(r"\s", q[2])):
        a, b = q.span(2)
    elif q:
        return None
    else:
        b = _BARE.match(t, a := at + (t[at : at + 1] in ('"', "'", "`"))).end()
    return (a, b) if b - a >= (4 if password else 6) else None


def _secrets(t: str, out: list[Span]) -> None:
    end = 0  # what begins within a value is part of it and isn't read again
    if (":" in t or "=" in t) and any(k in low for low in [t.lower()] for k in _KEYWORD_PARTS):
        for m in _ASSIGN.finditer(t):
            if (i := m.start()) < end:
                continue
            e = i
            while e > end and t[e - 1] in " \t":
                e -= 1
            e -= t[e - 1 : e] == "]"
            e -= t[e - 1 : e] in ('"', "'", "`")
            if (k := _KEYWORD.search(t, max(0, e - _KEYWORD_CHARS), e)) and (v := _assigned(t, i, k[0][:1] in "pP" and k[0][:2] not in ("pr", "Pr", "PR"))):
                out.append((*v, "secret", t[v[0] : v[1]]))
                end = v[1]
    if any(p in t for p in _PREFIXES):
        out += [(m.start(), m.end(), "secret", m[0]) for m in _PREFIXED.finditer(t)]
    if "PRIVATE KEY-----" in t:
        out += [(m.start(2), m.end(2), "secret", m[2]) for m in _KEYBLOCK.finditer(t)]


def _numbers(t: str, out: list[Span]) -> None:
    at = 0
    while m := _NUMBER.search(t, at):
        s = m.start()
        left = s
        while m[0].isdigit() and left > at and t[left - 1].isascii() and t[left - 1].isalnum():
            left -= 1
        if left < s or (m[0].isdigit() and s + 1 < len(t) and t[s + 1].isalpha()):
            right = _WORDCHARS_ON.match(t, s).end()
            word = t[left:right]
            at = max(right, m.end())
            if right - left >= 32 and _HEX.match(word):
                out.append((left, right, "secret", word))
            elif s - left == 2 and (i := _IBAN.match(t, left)) and not (left and t[left - 1].isalnum()):
                canonical = i[0].replace(" ", "")
                if 15 <= len(canonical) <= 34 and _iban_mod(canonical) == 1:
                    out.append((left, i.end(), "iban", canonical))
                    at = i.end()
            continue
        if (x := _IP4.match(t, s)) and not (s and t[s - 1] in "."):
            out.append((s, x.end(), "ipv4", x[0]))
            at = x.end()
            continue
        end = _DIGITS.match(t, m.end() - 1).end()
        if end < len(t) and t[end].isalnum():
            word = t[s : _WORDCHARS_ON.match(t, s).end()]
            if len(word) >= 32 and _HEX.match(word):
                out.append((s, s + len(word), "secret", word))
            at = max(end, s + len(word))
            continue
        at = end
        digits = t[s:end]
        if m[0].isdigit() and len(digits) >= 32:
            out.append((s, end, "secret", digits))
        elif m[0].isdigit() and (x := _SSN.match(t, s)):
            out.append((s, at := x.end(), "ssn", re.sub(r"\D", "", x[0])))
        elif m[0].isdigit() and (x := _CARD.match(t, s)):
            out.append((s, at := x.end(), "card", re.sub(r"\D", "", x[0])))
        else:
            for one in _PHONES:
                if (x := one.match(t, s)) and 8 <= len(digits := re.sub(r"\D", "", x[0])) <= 15:
                    out.append((s, at := x.end(), "phone", digits))
                    break


def _named(t: str, at: int) -> list[tuple[int, str]]:
    """The words of a name from ``at``: listed given names, then the surname; initials are skipped. Where the first word that isn't listed
    is followed by another capitalised one, it may be a given name: both are taken, unless in capitals throughout."""
    words: list[tuple[int, str]] = []
    dotted, last = True, False
    while m := _MORE.match(t, at):
        w = m[2].removesuffix("'s").removesuffix("’s")
        if m[1] and not dotted:
            break
        if len(w) == 1 and w.isupper():
            dotted = True
        elif not names.capital(w) or (last and w.isupper()):
            break
        else:
            words.append((m.start(2), w))
            dotted = False
            if last:
                break
            last = not names.gender_of(w)
        at = m.end()
    return words


def _canonical(word: str, given: bool, gender: str) -> str:
    return f"{names.script(word)}:{names.gender_of(word) if given else names.surname_gender(word, gender)}:{word.casefold()}"


def _persons(t: str, out: list[Span]) -> None:
    if not names.FIRSTS.isdisjoint(_CAPITALISED.findall(t)):
        _listed(t, out)
    for m in _LABEL.finditer(t) if ":" in t or "name is" in t else ():
        first = _FIRST.match(t, m.end())
        if not first or names.is_title(first[0]) or not names.capital(first[0]) or any(a <= m.end() < b for a, b, *_ in out):
            continue
        words = _named(t, first.end())
        for k, (a, w) in enumerate([(m.end(), first[0]), *words] if words else []):
            given = bool(names.gender_of(w)) and k < len(words)
            out.append((a, a + len(w), "given" if given else "surname", _canonical(w, given, "")))
    known = {t[a:b].casefold(): (kind, value) for a, b, kind, value in reversed(out)}
    if known:  # every further mention of a word that is a name in this text
        at = {a for a, *_ in out}
        words = sorted({t[a:b] for a, b, *_ in out}, key=lambda w: (-len(w), w))
        again = re.compile(r"(?<![^\W_])(?:" + "|".join(map(re.escape, words)) + r")(?![^\W_])", re.IGNORECASE)
        out += [(m.start(), m.end(), *known[m[0].casefold()]) for m in again.finditer(t) if m.start() not in at and names.capital(m[0]) and m[0].casefold() in known]


def _listed(t: str, out: list[Span]) -> None:
    """Names that begin with a listed given name or a form of address."""
    at = 0
    while m := _CAPS.search(t, at):
        s = m.start()
        at = m.end()
        if s and (t[s - 1].isalnum() or t[s - 1] == "_"):
            continue
        p = _FIRST.match(t, s)
        if not p:
            continue
        first = p[0]
        title, given = names.is_title(first), names.gender_of(first) and names.capital(first)
        words = _named(t, p.end()) if title or given else []
        if not words:
            continue
        if title:
            gender = names.title_gender(first)
        else:
            words, gender = [(s, first), *words], names.gender_of(first)
        for k, (a, w) in enumerate(words):
            given = bool(names.gender_of(w)) and k < len(words) - 1
            out.append((a, a + len(w), "given" if given else "surname", _canonical(w, given, gender)))
        at = words[-1][0] + len(words[-1][1])


def find(t: str | None) -> list[Span]:
    """Entities of a text in order, none overlapping: of overlapping ones the first kind below wins."""
    if not t:
        return []
    kinds: list[list[Span]] = []
    for part, wanted in ((_secrets, ":" in t or "=" in t or any(p in t for p in _PREFIXES)), (_emails, "@" in t), (_numbers, _DIGITS.search(t)), (_persons, True)):
        one: list[Span] = []
        if wanted:
            part(t, one)
        kinds.append(one)
    if t.count(":") > 3:
        kinds.insert(2, [(m.start(), m.end(), "ipv6", m[0].lower()) for m in _IP6.finditer(t) if m[0].count(":") >= 3])
    found: list[Span] = []
    for one in kinds:
        for x in one:
            i = bisect.bisect(found, x)
            if (not i or found[i - 1][1] <= x[0]) and (i == len(found) or x[1] <= found[i][0]):
                found.insert(i, x)
    return found


class _Draw:
    """A stream of numbers from key, kind, value and attempt."""

    def __init__(self, key: bytes, *parts: str):
        self.key, self.seed, self.n, self.pool = key, "\0".join(parts).encode("utf-8", "replace"), 0, b""

    def below(self, m: int) -> int:
        if len(self.pool) < 4:
            self.pool += hmac.new(self.key, self.seed + b"\0" + str(self.n).encode(), hashlib.sha256).digest()
            self.n += 1
        x, self.pool = int.from_bytes(self.pool[:4], "big"), self.pool[4:]
        return x % m


_LETTERS = {"latin": "abcdefghijklmnopqrstuvwxyz", "cyrillic": "абвгдежзиклмнопрстуфхцчшщэюя", "greek": "αβγδεζηθικλμνξοπρστυφχψω"}


def _shape(s: str, d: _Draw, hexes: bool = False) -> str:
    out = []
    for c in s:
        if c.isdigit():
            out.append(str(d.below(10)) if not hexes else "0123456789abcdef"[d.below(16)] if s == s.lower() else "0123456789ABCDEF"[d.below(16)])
        elif hexes and c in "abcdefABCDEF":
            out.append(("0123456789abcdef" if c.islower() or s == s.lower() else "0123456789ABCDEF")[d.below(16)])
        elif c.isalpha():
            letters = _LETTERS[names.script(c)]
            drawn = letters[d.below(len(letters))]
            out.append(drawn.upper() if c.isupper() else drawn)
        else:
            out.append(c)
    return "".join(out)


@functools.lru_cache(maxsize=200_000)
def surrogate(key: bytes, kind: str, value: str, attempt: int = 0) -> str:
    """The canonical surrogate of a canonical value."""
    d = _Draw(key, kind, value, str(attempt))
    more = "".join(str(d.below(10)) for _ in range(max(0, attempt - 8)))
    if kind == "email":
        local, _, domain = value.rpartition("@")
        *labels, top = domain.split(".")
        at = _Draw(key, "domain", domain)  # one domain, one surrogate
        reserved = labels[-1:] if labels[-1:] == ["example"] else []  # example.com and its like belong to nobody
        return _shape(local, d) + more + "@" + ".".join([*(_shape(x, at) for x in labels[: len(labels) - len(reserved)]), *reserved, top])
    if kind == "phone":
        keep = 1 if len(value) == 11 and value[0] == "1" else 2
        return value[:keep] + "".join(str(d.below(10)) if c == "0" or i else str(1 + d.below(9)) for i, c in enumerate(value[keep:])) + more
    if kind == "card":
        body = value[0] + "".join(str(d.below(10)) for _ in value[2:])
        check = next(c for c in "0123456789" if luhn(body + c))
        return (body + check if luhn(value) else body + str((int(check) + 1 + d.below(9)) % 10)) + more
    if kind == "ipv4":
        a = [int(x) for x in value.split(".")]
        fixed = [a[0]] if a[0] in (10, 127) else a[:2] if a[:2] == [192, 168] or (a[0] == 172 and 16 <= a[1] < 32) else []
        b = fixed + [1 + d.below(254) for _ in a[len(fixed) :]]
        while not fixed and (b[0] in (10, 127) or b[:2] == [192, 168] or (b[0] == 172 and 16 <= b[1] < 32)):
            b[0] = 1 + d.below(223)
        return ".".join(map(str, b)) + more
    if kind == "iban":
        body = value[:2] + "00" + _shape(value[4:], d)
        return body[:2] + f"{98 - _iban_mod(body):02d}" + body[4:] + more
    if kind == "ssn":
        return f"{1 + d.below(665):03d}{1 + d.below(99):02d}{1 + d.below(9999):04d}" + more
    if kind == "ipv6":
        return ":".join(x and f"{1 + d.below(65535):x}" for x in value.split(":")) + more
    if kind == "secret":
        prefix = next((p for p in _PREFIXES if value.startswith(p)), "")
        rest = value[len(prefix) :]
        return prefix + _shape(rest, d, hexes=len(rest) >= 16 and re.fullmatch(r"[0-9a-f]+|[0-9A-F]+", rest) is not None) + more
    script, gender, word = value.split(":", 2)
    if kind == "given":
        return f"{script}:{gender}:{names.permuted(key, script, gender, word)}"
    return f"{script}:{gender}:{names.surname(d, script, gender, attempt)}"


def render(mention: str, kind: str, canonical: str) -> str:
    """A canonical surrogate in the format of the mention that it replaces."""
    if kind in ("phone", "card", "ssn"):
        digits = iter(canonical)
        return "".join(next(digits, "") if c.isdigit() else c for c in mention) + "".join(digits)
    if kind == "iban":
        chars = iter(canonical)
        return "".join(next(chars, "") if c != " " else c for c in mention) + "".join(chars)
    if kind in ("given", "surname"):
        word = canonical.split(":", 2)[2]
        return word.upper() if mention.isupper() and len(mention) > 1 else "-".join(x[:1].upper() + x[1:] for x in word.split("-"))
    if kind in ("email", "ipv6"):
        return canonical.upper() if mention.isupper() else canonical
    return canonical


def tag(kind: str, value: str) -> str:
    return hashlib.md5(f"{kind}\0{value}".encode("utf-8", "replace")).hexdigest()


def replace(text: str | None, key: bytes, attempts: dict[str, int]) -> tuple[str | None, int]:
    spans = find(text)
    if not spans:
        return text, 0
    out, at = [], 0
    for a, b, kind, value in spans:
        out += [text[at:a], render(text[a:b], kind, surrogate(key, kind, value, attempts.get(tag(kind, value), 0) if attempts else 0))]
        at = b
    return "".join([*out, text[at:]]), len(spans)


def _extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ths, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        rows = {(h, k, v) for h, t in zip(ths, texts) for _, _, k, v in find(t)}
        cols = list(zip(*sorted(rows))) if rows else [(), (), ()]
        yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.string()), pa.array(cols[2], pa.string())], names=["th", "kind", "value"])


def entities(texts: DataFrame) -> DataFrame:
    """th, kind, value: the distinct canonical entities of each text."""
    return texts.select(F.xxhash64("text").alias("th"), "text").mapInArrow(_extracted, "th long, kind string, value string")


def resolve(values: DataFrame, key: bytes, ws: Workspace, max_rounds: int = 64) -> DataFrame:
    """kind, value, attempt of the values whose first surrogate collides (``values``: distinct kind and value)."""

    @F.pandas_udf("string")
    def drawn(kind: pd.Series, value: pd.Series, attempt: pd.Series) -> pd.Series:
        return pd.Series([surrogate(key, k, v, a) for k, v, a in zip(kind, value, attempt)], dtype=object)

    # given names are permuted, so they can't collide
    live = values.filter("kind <> 'given'")
    now = ws.save(live.withColumn("attempt", F.lit(0)).withColumn("s", drawn("kind", "value", "attempt")))
    real = live.select("kind", F.col("value").alias("s"))
    for _ in range(max_rounds):
        first = now.groupBy("kind", "s").agg(F.min(F.struct("attempt", "value")).alias("first"), F.count("*").alias("n"))
        shared = now.join(first.filter("n > 1"), ["kind", "s"]).filter(F.struct("attempt", "value") != F.col("first")).select("kind", "value")
        taken = now.join(real, ["kind", "s"], "left_semi").select("kind", "value")
        again = ws.save(shared.union(taken).distinct())
        if again.isEmpty():
            return now.filter("attempt > 0").select("kind", "value", "attempt")
        redrawn = now.join(again, ["kind", "value"], "left_semi").select("kind", "value", (F.col("attempt") + 1).alias("attempt")).withColumn("s", drawn("kind", "value", "attempt"))
        now = ws.save(now.join(again, ["kind", "value"], "left_anti").unionByName(redrawn))
    raise RuntimeError(f"surrogates still collide after {max_rounds} draws")


def replaced(docs: DataFrame, key: bytes, text: str = "text", broadcast_rows: int = 200_000) -> DataFrame:
    """``docs`` with the entities of ``text`` replaced and a column __lw_n, their number."""
    ws = Workspace(docs.sparkSession, "pii")
    body = col(text)
    found = entities(docs.select(body.alias("text")))
    values = ws.save(found.select("kind", "value").distinct())
    odd = ws.save(resolve(values, key, ws).withColumn("tag", F.md5(F.concat("kind", F.lit("\0"), "value"))))
    n = odd.count()
    if n <= broadcast_rows:
        held = docs.sparkSession.sparkContext.broadcast({r.tag: r.attempt for r in odd.select("tag", "attempt").collect()})

        @F.pandas_udf("text string, n int")
        def swap(texts: pd.Series) -> pd.DataFrame:
            return _swapped(texts, key, (held.value for _ in texts))

        done = docs.withColumn("__lw_pii", swap(body))
    else:
        own = found.join(odd, ["kind", "value"]).groupBy("th").agg(F.collect_list(F.struct("tag", "attempt")).alias("__lw_odd"))

        @F.pandas_udf("text string, n int")
        def swap_odd(texts: pd.Series, odds: pd.Series) -> pd.DataFrame:
            return _swapped(texts, key, ({} if o is None else {x["tag"]: x["attempt"] for x in o} for o in odds))

        joined = docs.join(own.withColumnRenamed("th", "__lw_th"), F.xxhash64(body) == F.col("__lw_th"), "left")
        done = joined.withColumn("__lw_pii", swap_odd(body, F.col("__lw_odd")))
    return done.select(*[F.col("__lw_pii.text").alias(c) if c == text else col(c) for c in docs.columns], F.col("__lw_pii.n").alias("__lw_n"))


def _swapped(texts: pd.Series, key: bytes, attempts) -> pd.DataFrame:
    got = [replace(t, key, o) for t, o in zip(texts, attempts)]
    return pd.DataFrame({"text": pd.Series([x[0] for x in got], dtype=object), "n": [x[1] for x in got]})


def pseudonymise(docs: DataFrame, key: bytes, doc_id: str = "doc_id", text: str = "text", **params) -> DataFrame:
    """Columns doc_id, text (with surrogates), n_entities: one row for each row of ``docs``."""
    got = replaced(docs.select(col(doc_id).alias("doc_id"), col(text).alias("text")), key, **params)
    return got.select("doc_id", "text", F.col("__lw_n").alias("n_entities"))
