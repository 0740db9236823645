"""Checks of values that were read: digits, checksums, labels, OCR status."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Labels, digit counts by label, weights and day limits of the resident number.
LABELS = ["NAME", "RRN", "ADDRESS", "EMAIL", "IP", "ACCOUNT_NO", "CARD_NO", "PHONE", "PASSPORT", "BIRTH"]
DIGIT_LENGTHS = {"RRN": [13], "CARD_NO": [15, 16]}
RRN_WEIGHTS = [2, 3, 4, 5, 6, 7, 8, 9, 2, 3, 4, 5]
MONTH_DAYS = [31, 29, 31, 30, 31, 30, 31, 31, 30, 31, 30, 31]
# Field names that are no personal data.
FIELD_LABELS = """성명 이름 주민등록번호 주민번호 생년월일 출생연월일 주소 연락처 전화번호 휴대전화 이메일 전자우편
직장명 소속 직위 사업자등록번호 법인등록번호 계좌번호 카드번호 여권번호 운전면허번호 예금주 서명 날인
귀하 신청인 대표자 담당자 담당 본인 고객명 고객 한글성명 영문성명 직책 부서 회사명 상호 법인명
자택주소 현주소 주민등록상주소 이메일주소 휴대폰 휴대폰번호 전화 구분 성별 관계 세대주 가족사항
등록기준지 본 비고""".split()
_FULL_WIDTH = "０１２３４５６７８９"


def digits_only(text: Column) -> Column:
    """Decimal digits; full-width ones become ASCII, what is no decimal digit goes."""
    return F.regexp_replace(F.translate(text, _FULL_WIDTH, "0123456789"), "[^0-9]", "")


def _digits(d: Column) -> Column:
    return F.transform(F.split(d, ""), lambda c: c.try_cast("int"))


def rrn_check_digit(first12: Column) -> Column:
    values = F.slice(_digits(first12), 1, 12)
    total = F.aggregate(F.zip_with(values, F.array(*[F.lit(w) for w in RRN_WEIGHTS]), lambda v, w: v * w), F.lit(0), lambda s, x: s + x)
    return (11 - total % 11) % 10


def rrn_valid(text: Column) -> Column:
    """Thirteen digits, a month and a day that exist (29 February in every year), and the check digit."""
    d = digits_only(text)
    month, day = F.substring(d, 3, 2).try_cast("int"), F.substring(d, 5, 2).try_cast("int")
    days = F.try_element_at(F.array(*[F.lit(x) for x in MONTH_DAYS]), F.when(month > 0, month).otherwise(13))
    ok = (F.length(d) == 13) & month.between(1, 12) & (day >= 1) & (day <= days) & (rrn_check_digit(d) == F.substring(d, 13, 1).try_cast("int"))
    return F.coalesce(ok, F.lit(False))


def luhn_valid(text: Column) -> Column:
    """Thirteen to nineteen digits with a right Luhn sum; separators do not count."""
    d = digits_only(text)
    return F.coalesce(F.when(F.length(d).between(13, 19), F.call_function("luhn_check", d)), F.lit(False))


#: Label: whether a text passes the label's checksum. Labels without one are not listed.
VALIDATORS: dict[str, Callable[[Column], Column]] = {"RRN": rrn_valid, "CARD_NO": luhn_valid}


def candidate_texts(*texts: Column) -> Column:
    """Distinct texts that are not blank; any engine's reading may pass a check."""
    given = F.array_compact(F.array(*texts))
    return F.array_distinct(F.filter(given, lambda t: F.trim(t) != ""))


def checksum(label: Column, texts: Column) -> Column:
    """ok, failed, or null where the label has no checksum or nothing was read."""
    out = F.lit(None).cast("string")
    for name, valid in VALIDATORS.items():
        out = F.when((label == name) & (F.size(texts) > 0), F.when(F.exists(texts, valid), "ok").otherwise("failed")).otherwise(out)
    return out


def digit_problem(label: Column, texts: Column) -> Column:
    """Why no text has a digit count that the label allows; null if one has, or the label does not fix it."""
    lengths = F.array_sort(F.array_distinct(F.transform(texts, lambda t: F.length(digits_only(t)))))
    out = F.lit(None).cast("string")
    for name, allowed in DIGIT_LENGTHS.items():
        fits = F.arrays_overlap(lengths, F.array(*[F.lit(n) for n in allowed]))
        hint = F.lit("")
        for other, its in DIGIT_LENGTHS.items():
            if other != name:
                hint = F.when(F.arrays_overlap(lengths, F.array(*[F.lit(n) for n in its])), f"; the count fits {other}").otherwise(hint)
        said = F.concat(F.lit(f"digit count: {name} has {'/'.join(map(str, allowed))}, read "), F.array_join(F.transform(lengths, lambda n: n.cast("string")), "/"), hint)
        out = F.when((label == name) & (F.size(texts) > 0) & ~fits, said).otherwise(out)
    return out


def is_resident_number(label: Column, texts: Column) -> Column:
    """Another label holds a value that can only be a resident number."""
    return (label != "RRN") & F.exists(texts, rrn_valid)


def is_field_label(text: Column) -> Column:
    bare = F.regexp_replace(F.coalesce(text, F.lit("")), r"(?U)[\s:：()\[\]]", "")
    return bare.isin(*FIELD_LABELS)


def ocr_status(text: Column, conf: Column, ok: float = 0.80, floor: float = 0.35) -> Column:
    blank = F.coalesce(F.trim(text), F.lit("")) == ""
    return F.when(blank | (conf < floor), "FAILED").when(conf < ok, "LOW_CONF").otherwise("OK")


def worst_status(statuses: Column) -> Column:
    """The worst of some statuses, OK for none."""
    return F.when(F.array_contains(statuses, "FAILED"), "FAILED").when(F.array_contains(statuses, "LOW_CONF"), "LOW_CONF").otherwise("OK")


def refined_confidence(agreement: Column, conf: Column) -> Column:
    """Agreement of two engines lifts the confidence to 0.9, and holds it at 0.95."""
    return F.when(agreement == "EXACT", F.least(F.lit(0.95), F.greatest(conf, F.lit(0.9)))).otherwise(conf)
