"""Personal data by anchor expansion: an Aho-Corasick automaton finds cues, local parsers grow and check them.

Cues: at-signs (email), digit-dot-digit (ip), two neighbouring digits (card), plus-digit (phone), ``://`` (url) and account
words (account).  From each cue a parser expands to the left and right boundary and validates, starting no
earlier than the end of the kind's last match, which gives the leftmost non-overlapping matches of each pattern.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import cache
from hashlib import sha256

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from riskframe.llm.common import table
from riskframe.session import ship_package

KINDS = ("email", "ip", "card", "phone", "url", "account")
BASE = KINDS[:4]
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DIGITS = "0123456789"
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
SCHEME = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+.-")
URL_REST = re.compile(r"[^\s<>\"']+")
ACCOUNT_CUES = ("IBAN", "iban", "Account", "account", "Acct", "acct")
LEAD = re.compile(r"(?:[\x20:#.-]|[Nn]o\b|[Nn]umber\b)*+")  # between a cue and its account
ACCOUNT = re.compile(r"(?=[A-Z0-9-]*[0-9]{4})[A-Z0-9][A-Z0-9-]{5,33}(?![A-Za-z0-9])")
# Bank account in the international form: country, two check digits, groups of four (printed apart or not), the last may be shorter.
IBAN = re.compile(r"[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?")
IBAN_LENGTHS = range(15, 35)


@cache
def automaton() -> ahocorasick.Automaton:
    a = ahocorasick.Automaton()
    cues = [("@", "email"), ("://", "url"), *((w, "account") for w in ACCOUNT_CUES), *(("+" + d, "phone") for d in DIGITS),
            *((f"{x}.{y}", "ip") for x in DIGITS for y in DIGITS), *((x + s + y, "card") for x in DIGITS for s in ("", " ", "-") for y in DIGITS)]
    for cue, kind in cues:
        a.add_word(cue, (kind, len(cue)))
    a.make_automaton()
    return a


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2])) + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return total % 10 == 0


def mod97(account: str) -> bool:
    """Check digits of an international account number: the first four characters moved behind, letters from A = 10."""
    return int("".join(str(int(c, 36)) for c in account[4:] + account[:4])) % 97 == 1


def account_end(text: str, start: int, strict: bool) -> int | None:
    """Where the account that starts at ``start`` ends, or None.

    The longest run of groups with right check digits is an international number.  What only looks like one is none; other
    tokens with four digits in a row are accounts unless ``strict``.
    """
    if m := IBAN.match(text, start):
        for end in range(m.end(), start, -1):
            whole = not (end < len(text) and text[end].isalnum()) and text[end - 1] != " "
            plain = text[start:end].replace(" ", "")
            if whole and len(plain) in IBAN_LENGTHS and mod97(plain):
                return end
        if strict or " " not in m[0]:
            return None
    if strict or not (m := ACCOUNT.match(text, start)):
        return None
    return m.end()


def find(text: str) -> dict[str, list[tuple[int, int]]]:
    """Spans (code points, end exclusive) by kind, in order of start."""
    out: dict[str, list[tuple[int, int]]] = {k: [] for k in KINDS}
    done = dict.fromkeys(KINDS, 0)  # where the last match of a kind ended, validated or not
    for last, (kind, size) in automaton().iter(text):
        at, floor = last + 1 - size, done[kind]
        if at < floor:
            continue
        if kind == "card":
            m = CARD.match(text, at)  # the first pair of a chain starts it
            done[kind] = m.end()
            digits = m[0].replace(" ", "").replace("-", "")
            if 16 <= len(digits) <= 19 and luhn(digits):
                out[kind].append(m.span())
        elif kind == "email":
            start = at
            while start > floor and text[start - 1] in LOCAL:
                start -= 1
            if start < at and (m := DOMAIN.match(text, at + 1)):
                done[kind] = m.end()
                out[kind].append((start, m.end()))
        elif kind == "ip":
            start = at
            while start > floor and text[start - 1] in DIGITS:
                start -= 1
            if m := IP.match(text, start):
                done[kind] = m.end()
                if all(len(p := x.lstrip("0")) <= 3 and int(p or 0) <= 255 for x in m[0].split(".")):
                    out[kind].append(m.span())
        elif kind == "phone":
            if m := PHONE.match(text, at):
                done[kind] = m.end()
                if 8 <= sum(c in DIGITS for c in m[0]) <= 15:
                    out[kind].append(m.span())
        elif kind == "url":
            start = at
            while start > floor and text[start - 1] in SCHEME:
                start -= 1
            while start < at and not text[start].isalpha():
                start += 1
            if start < at and (m := URL_REST.match(text, at + 3)):
                end = at + 3 + len(m[0].rstrip(".,;:!?)]}"))
                if end > at + 3:
                    done[kind] = end
                    out[kind].append((start, end))
        elif at == 0 or not text[at - 1].isalnum():
            start = LEAD.match(text, last + 1).end()
            if end := account_end(text, start, strict=size == len("IBAN") and text[at : last + 1].upper() == "IBAN"):
                done[kind] = end
                out[kind].append((start, end))
    return out


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows: list[list] = [[] for _ in range(6)]
        for value in batch.column(1):
            found = find(value.as_py() or "")
            text = {k: ",".join(f"{k}:{a}:{b}" for a, b in found[k]) for k in KINDS}
            base = ",".join(filter(None, (text[k] for k in BASE)))
            for row, x in zip(rows, [*(len(found[k]) for k in BASE), sha256(base.encode()).hexdigest(), ",".join(filter(None, text.values()))]):
                row.append(x)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), *(pa.array(r, pa.int64()) for r in rows[:4]), *(pa.array(r, pa.string()) for r in rows[4:])],
            names=["id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"])


def find_private(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: counts by base kind, the digest of the base spans and all spans.  Null text is empty; repeated rows
    and null ids give a row each; other columns are ignored.  One map over the rows, no shuffle."""
    ship_package(docs.sparkSession)
    return (docs.selectExpr(f"cast(`{id_col}` as long) as id", f"cast(`{text_col}` as string) as text")
            .mapInArrow(_scan, "id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string"))


def op8_private(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_private(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")
