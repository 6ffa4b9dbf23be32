"""Personal data: patterns propose, checksums confirm, words nearby weigh.

A regular expression proposes spans of each kind, leftmost and not overlapping within the kind.
A validator confirms them: number of digits, parts of an address, Luhn, mod-97, the weighted sum
of bank numbers. The score is that of the pattern, more if confirmed, more if a telling word
stands within `REACH` characters, less if a word there tells otherwise.

  base   email, ip, card, phone: reported if confirmed, whatever the score
  added  iban, ssn, routing, local (a phone number without country): reported if confirmed, with a
         score of `least` or more, and clear of base spans and of added kinds named before it

Patterns never try a run of letters or digits from each of its characters, so the cost is in
proportion to the text, also of one long word: an address is found at its `@` and read backwards,
digits are taken from the start of their run and not given back.

Nulls: a null text is empty; a null id stays null. Repeated rows have equal results. Spans with
the same start are ordered by kind. An empty table gives an empty result, other columns are not
read (`mask_personal` hands them on), texts are scanned whole. Positions are code points, ends
exclusive. One pass over the texts, without a shuffle.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sedimenta.llm.words import column, slices

REACH = 40
LEAST = 0.5
NEAR, FAR = 0.3, -0.3
BASE = ("email", "ip", "card", "phone")


def _digits(text: str) -> list[int]:
    return [ord(c) - 48 for c in text if "0" <= c <= "9"]


def luhn(text: str) -> bool:
    """Every second digit from the right doubled, crosswise sums added: a multiple of 10."""
    digits = _digits(text)
    doubled = (sum(divmod(2 * d, 10)) for d in digits[-2::-2])
    return (sum(digits[-1::-2]) + sum(doubled)) % 10 == 0


def mod97(text: str) -> bool:
    """The first four characters put last, letters as 10 to 35: a number with remainder 1."""
    plain = text.replace(" ", "")
    if not 15 <= len(plain) <= 34:
        return False
    return int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97 == 1


def _parts(text: str) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in text.split("."))


def _card(text: str) -> bool:
    return 14 <= len(_digits(text)) <= 19 and luhn(text)


def _phone(text: str) -> bool:
    return 10 <= len(_digits(text)) <= 15


def _ssn(text: str) -> bool:
    area, group, serial = text.split("-")
    return area not in ("000", "666") and area < "900" and group != "00" and serial != "0000"


def _routing(text: str) -> bool:
    digits = _digits(text)
    return any(digits) and sum(d * w for d, w in zip(digits, (3, 7, 1) * 3, strict=True)) % 10 == 0


_LABELS = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL_PART = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")


def _addresses(text: str) -> Iterator[tuple[int, int]]:
    done = 0
    for m in _LABELS.finditer(text):
        start = m.start()
        while start > done and text[start - 1] in _LOCAL_PART:
            start -= 1
        if start < m.start():
            done = m.end()
            yield start, done


def _matches(pattern: str) -> Callable[[str], Iterator[tuple[int, int]]]:
    compiled = re.compile(pattern)
    return lambda text: (m.span() for m in compiled.finditer(text))


_ACCOUNT = _matches(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")


def _accounts(text: str) -> Iterator[tuple[int, int]]:
    """The longest start of a match, up to one of its blanks, that is confirmed; else the match."""
    for start, end in _ACCOUNT(text):
        ends = [end, *(start + i for i in range(end - start - 1, 14, -1) if text[start + i] == " ")]
        yield start, next((e for e in ends if mod97(text[start:e])), end)


@dataclass(frozen=True)
class Kind:
    propose: Callable[[str], Iterator[tuple[int, int]]]
    confirm: Callable[[str], bool]
    pattern_score: float
    confirmed_score: float
    near: frozenset[str]
    far: frozenset[str] = frozenset()


def _words(text: str) -> frozenset[str]:
    return frozenset(text.split())


# Words that speak for and against a kind, in English, German, French and Spanish.
_CALL = _words("phone telephone tel call mobile cell fax telefon anrufen rufnummer mobil handy téléphone appeler portable teléfono llamar móvil")
_PAY = _words("card credit debit visa mastercard amex payment karte kreditkarte zahlung carte crédit paiement tarjeta crédito pago")
_MAIL = _words("email mail contact write adresse kontakt schreiben courriel contacter correo contacto")
_NET = _words("ip address host server client login adresse rechner serveur hôte servidor dirección")
_BANK = _words("iban bank account konto überweisung compte virement banque cuenta banco transferencia")
_TAX = _words("ssn social security insurance taxpayer")
_ROUTE = _words("routing aba bank transit wire deposit")
_NUMBER = _words("version release order invoice isbn issn serial part item sku bestellung rechnung commande facture pedido factura")

KINDS: dict[str, Kind] = {
    "email": Kind(_addresses, lambda text: True, 0.8, 0.0, _MAIL),
    "ip": Kind(_matches(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"), _parts, 0.4, 0.2, _NET, _NUMBER),
    "card": Kind(_matches(r"[0-9](?:[\x20-]?[0-9])++"), _card, 0.2, 0.5, _PAY, _NUMBER),
    "phone": Kind(_matches(r"\+[0-9][\x20().0-9-]+[0-9]"), _phone, 0.4, 0.2, _CALL, _NUMBER),
    "iban": Kind(_accounts, mod97, 0.2, 0.5, _BANK, _NUMBER),
    "ssn": Kind(_matches(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"), _ssn, 0.2, 0.1, _TAX, _NUMBER),
    "routing": Kind(_matches(r"(?<![0-9])[0-9]{9}(?![0-9])"), _routing, 0.1, 0.2, _ROUTE, _NUMBER),
    "local": Kind(
        _matches(r"(?<![0-9(+])(?:\([0-9]{3}\)\x20?|[0-9]{3}[\x20.-])[0-9]{3}[\x20.-][0-9]{4}(?![0-9])"),
        lambda text: True, 0.3, 0.0, _CALL, _NUMBER,
    ),
}
_ANY = re.compile("[0-9@]")
_WORD = re.compile(r"[^\W\d_]+")


def _nearby(text: str, start: int, end: int, reach: int) -> set[str]:
    """Whole words within reach, in small letters."""
    least, most = max(0, start - reach), min(len(text), end + reach)
    before, after = _WORD.findall(text[least:start]), _WORD.findall(text[end:most])
    if before and least and text[least].isalpha() and text[least - 1].isalpha():
        before = before[1:]
    if after and most < len(text) and text[most].isalpha() and text[most - 1].isalpha():
        after = after[:-1]
    return {w.lower() for w in (*before, *after)}


def spans_of(text: str, least: float = LEAST, reach: int = REACH) -> list[tuple[int, int, str, float]]:
    """(start, end, kind, score) of what is reported of one text, by start, then kind."""
    if not _ANY.search(text):
        return []
    found: list[tuple[int, int, int, int, str, float]] = []
    for rank, (name, kind) in enumerate(KINDS.items()):
        taken = sorted((s, e) for s, _, e, *_ in found) if name not in BASE else []
        at = 0
        furthest = 0  # of the taken spans that start before the one looked at ends
        for start, end in kind.propose(text):
            if name not in BASE:
                while at < len(taken) and taken[at][0] < end:
                    furthest = max(furthest, taken[at][1])
                    at += 1
                if furthest > start:
                    continue
            if not kind.confirm(text[start:end]):
                continue
            words = _nearby(text, start, end, reach)
            score = kind.pattern_score + kind.confirmed_score
            score += NEAR * bool(words & kind.near) + FAR * bool(words & kind.far)
            if name in BASE or score >= least - 1e-9:
                found.append((start, rank, end, end, name, round(min(max(score, 0.0), 1.0), 3)))
    return [(start, end, name, score) for start, _, _, end, name, score in sorted(found)]


_FOUND = "array<struct<kind:string,start:long,end:long,score:double>>"


def find_personal(
    documents: DataFrame, least: float = LEAST, reach: int = REACH, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row a document: doc_id and the list `found` of (kind, start, end, score)."""
    kind = pa.list_(
        pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())])
    )

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows = [
                [{"kind": k, "start": s, "end": e, "score": score} for s, e, k, score in spans_of(text or "", least, reach)]
                for text in column(batch, "text").to_pylist()
            ]
            yield pa.RecordBatch.from_arrays([column(batch, "doc_id"), pa.array(rows, kind)], ["doc_id", "found"])

    texts = documents.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return texts.mapInArrow(scan, f"doc_id {texts.schema['doc_id'].dataType.simpleString()}, found {_FOUND}")


def mask_personal(
    documents: DataFrame, least: float = LEAST, reach: int = REACH, text_col: str = "text"
) -> DataFrame:
    """The documents with each reported span replaced by its kind in angle brackets."""

    def masked(text: str | None) -> str | None:
        parts, at = [], 0
        for start, end, kind, _ in spans_of(text or "", least, reach):
            if start >= at:
                parts += [text[at:start], f"<{kind}>"]
            at = max(at, end)
        return "".join([*parts, text[at:]]) if parts else text

    def mask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text_col):
            i = batch.schema.get_field_index(text_col)
            texts = pa.array([masked(x) for x in batch.column(i).to_pylist()], batch.schema.field(i).type)
            yield batch.set_column(i, batch.schema.field(i), texts)

    return documents.mapInArrow(mask, documents.schema)


def personal_report(found: DataFrame) -> DataFrame:
    """Counts of the base kinds, a digest of their spans, and all spans as text."""
    said = lambda spans: F.array_join(
        F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ","
    )
    count = lambda k: F.size(F.filter("found", lambda x: x["kind"] == k)).cast("long").alias(f"n_{k}")
    base = F.filter("found", lambda x: x["kind"].isin(*BASE))
    return found.select(
        "doc_id", *(count(k) for k in BASE), F.sha2(said(base).cast("binary"), 256).alias("base_sha256"),
        said(F.col("found")).alias("spans"),
    )
