"""Repetition rules: how much of a text lies inside duplicated n-grams and lines.

Words are runs of anything but ASCII white space; in scripts without spaces (Chinese, Thai and their like) each character is a word. One
polynomial over a text's word hashes gives the rolling hash of every n-gram of every length as a difference of two sums. An n-gram that occurs
twice or more is duplicated at all its places, the first among them, and the measure is the share of the words' characters that lie
inside duplicated n-grams, each counted once however many n-grams cover it. Only places whose shorter n-gram is duplicated are looked at for the
next length. Lines are stripped; blank ones don't count. ``dup_lines`` is the share of lines with another copy in the text,
``dup_line_chars`` that of their characters.

A document is kept if no measure is above its limit. Null texts and texts without words have measures of 0 and are not
kept, as they have nothing to keep. A text of fewer than n words has no n-gram. Equal rows get equal results; an empty
table gives none. Only id and text are looked at; ids are of any type.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomwork.columns import col
from loomwork.llm.textkernels import UNSPACED, chunks, encode, hash_prefix, mix64, prefix_hashes, spans, word_prefix

#: Greatest share of characters in duplicated n-grams by n, and of lines. Published web-corpus filters count the repeats of a passage and have half
#: of these; as its first place counts here too, a passage that occurs twice has twice the share. Of the given documents labelled good 0.6 % are
#: beyond a limit, of those labelled bad 46 %; with the published numbers as they are 1.7 % and 47 %.
NGRAM_LIMITS = {5: 0.30, 6: 0.28, 7: 0.26, 8: 0.24, 9: 0.22, 10: 0.20}
LINE_LIMIT, LINE_CHAR_LIMIT = 0.60, 0.40
_SALT = np.uint64(0xC2B2AE3D27D4EB4F)


def repeated(keys: np.ndarray) -> np.ndarray:
    """Which values occur more than once."""
    order = np.argsort(keys)
    s = keys[order]
    same = s[1:] == s[:-1]
    out = np.zeros(len(keys), dtype=bool)
    out[order[1:][same]] = True
    out[order[:-1][same]] = True
    return out


def _per_text(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    total = np.concatenate(([0], np.cumsum(values)))
    return total[bounds[1:]] - total[bounds[:-1]]


def coverage(texts: list[bytes], lengths: tuple[int, ...]) -> np.ndarray:
    """One row a text: words, lines in duplicate, share of line characters in duplicate, then a share for each n."""
    out = np.zeros((len(texts), 3 + len(lengths)))
    for a, b in chunks(texts):
        buffer = np.frombuffer(b"\n".join(texts[a:b]) + b"\n", dtype=np.uint8)
        start, end = spans(buffer, "space")
        ends = np.cumsum([len(t) + 1 for t in texts[a:b]])
        bounds = np.concatenate(([0], np.searchsorted(start, ends)))
        words = np.diff(bounds)
        of = np.repeat(np.arange(b - a, dtype=np.uint64), words) * _SALT
        chars = np.concatenate(([0], np.cumsum((buffer & 0xC0) != 0x80)))
        prefix = hash_prefix(buffer)
        h = prefix_hashes(prefix, start, end)
        size = chars[end] - chars[start]
        whole = np.maximum(_per_text(size, bounds), 1)
        out[a:b, 0] = words
        if len(start):
            line = np.searchsorted(np.flatnonzero(buffer == 10), start)
            first = np.flatnonzero(np.concatenate(([True], line[1:] != line[:-1])))
            last = np.concatenate((first[1:] - 1, [len(start) - 1]))
            dup = repeated(mix64(prefix_hashes(prefix, start[first], end[last])) + of[first])
            at = np.searchsorted(first, bounds)
            long = chars[end[last]] - chars[start[first]]
            out[a:b, 1] = _per_text(dup, at) / np.maximum(np.diff(at), 1)
            out[a:b, 2] = _per_text(long * dup, at) / np.maximum(_per_text(long, at), 1)
        grams, at = word_prefix(h), np.arange(len(h))
        for k, n in enumerate(lengths):  # ascending: a duplicated n-gram begins with a duplicated shorter one
            at = at[at + n <= len(h)]
            at = at[of[at] == of[at + n - 1]]
            at = at[repeated(prefix_hashes(grams, at, at + n) + of[at])]
            if not len(at):
                break
            step = np.bincount(at, minlength=len(h) + 1) - np.bincount(at + n, minlength=len(h) + 1)
            out[a:b, 3 + k] = _per_text(size * (np.cumsum(step[:-1]) > 0), bounds) / whole
    return out


def repetition(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", limits: dict[int, float] | None = None, line_limit: float = LINE_LIMIT, line_char_limit: float = LINE_CHAR_LIMIT) -> DataFrame:
    """Columns doc_id, n_words, dup_lines, dup_line_chars, dup_{n} for each n, keep: one row for each row."""
    limits = limits or NGRAM_LIMITS
    lengths = tuple(sorted(limits))
    names = ["n_words", "dup_lines", "dup_line_chars", *(f"dup_{n}" for n in lengths)]
    most = np.array([line_limit, line_char_limit, *(limits[n] for n in lengths)])

    @F.pandas_udf(", ".join([f"{c} {'long' if c == 'n_words' else 'double'}" for c in names]) + ", keep boolean")
    def measure(texts: pd.Series) -> pd.DataFrame:
        got = coverage(encode(texts), lengths)
        out = pd.DataFrame({c: got[:, i].astype(np.int64) if c == "n_words" else got[:, i].round(6) for i, c in enumerate(names)})
        out["keep"] = (got[:, 0] > 0) & (got[:, 1:] <= most).all(axis=1)
        return out

    return docs.select(col(doc_id).alias("doc_id"), measure(col(text)).alias("m")).select("doc_id", "m.*")


def repetition_sql() -> str:
    """DuckDB SQL for ``repetition`` over documents."""
    space = r"[\t\n\v\f\r \x1c-\x1f]+"
    own = "".join(rf"\x{{{a:X}}}-\x{{{b:X}}}" for a, b in UNSPACED)
    shares = ", ".join(f"coalesce(max(case when n = {n} then share end), 0) as s{n}" for n in NGRAM_LIMITS)
    top = max(NGRAM_LIMITS)
    leads = ", ".join(f"lead(word, {i}) over x as l{i}" if i else "word as l0" for i in range(top))
    grams = " union all ".join(f"select doc_id, {n} as n, pos as i, hash({', '.join(f'l{i}' for i in range(n))}) as gram from k where l{n - 1} is not null" for n in NGRAM_LIMITS)
    return rf"""
with w as (select doc_id, regexp_extract_all(coalesce(text, ''), '[{own}]|[^{own}\t\n\v\f\r \x1c-\x1f]+') as words from documents),
t as (select doc_id, len(words) as n_words, list_sum(list_transform(words, lambda x: length(x))) as chars from w),
u as (select doc_id, unnest(words) as word, generate_subscripts(words, 1) as pos from w),
k as (select doc_id, pos, {leads} from u window x as (partition by doc_id order by pos)),
g as ({grams}),
r as (select doc_id, n, gram from g group by all having count(*) > 1),
p as (select distinct doc_id, n, unnest(range(i, i + n)) as pos from g join r using (doc_id, n, gram)),
s as (select p.doc_id, n, sum(length(word)) / max(chars) as share from p join u using (doc_id, pos) join t using (doc_id) group by p.doc_id, n),
l as (select doc_id, line, count(*) over (partition by doc_id, line) as c from (select doc_id, regexp_replace(unnest(string_split(text, chr(10))), '^{space}|{space}$', '', 'g') as line from documents) where line <> ''),
m as (select doc_id, avg((c > 1)::int) as dl, sum(case when c > 1 then length(line) else 0 end) / sum(length(line)) as dlc from l group by doc_id),
q as (select t.doc_id, n_words, coalesce(max(dl), 0) as dl, coalesce(max(dlc), 0) as dlc, {shares} from t left join m using (doc_id) left join s using (doc_id) group by t.doc_id, n_words)
select doc_id, n_words::bigint as n_words, round(dl, 6) as dup_lines, round(dlc, 6) as dup_line_chars, {", ".join(f"round(s{n}, 6) as dup_{n}" for n in NGRAM_LIMITS)},
  n_words > 0 and dl <= {LINE_LIMIT} and dlc <= {LINE_CHAR_LIMIT} and {" and ".join(f"s{n} <= {x}" for n, x in NGRAM_LIMITS.items())} as keep from q"""
