"""The silver cleaning rules as SQL expressions over column names.

Each function gives expression text for ``selectExpr`` or ``F.expr``. All are
built-in functions, so they stay inside whole-stage code generation.
"""

from __future__ import annotations

import datetime as dt

# Fixed values of the cleaning rules: code -> label, prefix, default label.
UNKNOWN = "n/a"
MARITAL_LABELS = {"S": "Single", "M": "Married"}
CRM_GENDER_LABELS = {"F": "Female", "M": "Male"}
ERP_GENDER_LABELS = {"F": "Female", "FEMALE": "Female", "M": "Male", "MALE": "Male"}
PRODUCT_LINE_LABELS = {"M": "Mountain", "R": "Road", "S": "Other Sales", "T": "Touring"}
COUNTRY_LABELS = {"DE": "Germany", "US": "United States", "USA": "United States"}
ERP_ID_PREFIX = "NAS"


def standardize(code: str, labels: dict[str, str], default: str = f"'{UNKNOWN}'") -> str:
    """The label of ``code``; ``default`` for codes without one and for NULL."""
    spellings: dict[str, list[str]] = {}
    for spelling, label in labels.items():
        spellings.setdefault(label, []).append(f"'{spelling}'")
    cases = " ".join(f"WHEN {code} IN ({', '.join(known)}) THEN '{label}'" for label, known in spellings.items())
    return f"CASE {cases} ELSE {default} END"


def code_label(column: str, labels: dict[str, str]) -> str:
    return standardize(f"upper(trim({column}))", labels)


def country_label(column: str) -> str:
    name = f"trim({column})"
    return standardize(name, COUNTRY_LABELS, f"coalesce(nullif({name}, ''), '{UNKNOWN}')")


def category_part(product_key: str) -> str:
    """The category id is the first five characters, written with underscores."""
    return f"translate(left({product_key}, 5), '-', '_')"


def product_part(product_key: str) -> str:
    """The product number starts after the category and its dash."""
    return f"substr({product_key}, 7)"


def customer_key_of(number: str) -> str:
    """The key a customer number is printed as: eight digits at least."""
    digits = f"CAST({number} AS string)"
    return f"concat('AW', lpad({digits}, greatest(8, length({digits})), '0'))"


def erp_customer_key(cid: str) -> str:
    bare = f"substr({cid}, {len(ERP_ID_PREFIX) + 1})"
    return f"if(startswith({cid}, '{ERP_ID_PREFIX}'), {bare}, {cid})"


def is_eight_long(number: str) -> str:
    """Whether an integer prints as eight characters, the minus sign included."""
    return f"({number} BETWEEN 10000000 AND 99999999 OR {number} BETWEEN -9999999 AND -1000000)"


def decode_int_date(number: str, on_invalid: str = "fail") -> str:
    """A yyyymmdd integer as a date.

    Anything that is not eight characters long means "no date". Eight
    characters that are no calendar day stop the job with ``on_invalid="fail"``
    (under ANSI mode, Spark's default) and become NULL with
    ``on_invalid="null"``. The usual form is integer arithmetic, free of string
    formatting and date patterns.
    """
    decoded = {
        "fail": f"make_date({number} div 10000, {number} div 100 % 100, {number} % 100)",
        "null": f"try_to_date(CAST({number} AS string), 'yyyyMMdd')",
    }[on_invalid]
    return f"CASE WHEN {is_eight_long(number)} THEN {decoded} END"


def as_of_day(as_of: dt.date | None) -> str:
    return "current_date()" if as_of is None else f"DATE '{as_of.isoformat()}'"


def not_after(day: str, as_of: dt.date | None) -> str:
    return f"if({day} <= {as_of_day(as_of)}, {day}, NULL)"


def repaired_sales(sales: str, quantity: str, price: str) -> str:
    """Recorded amount, recomputed where it is missing, not positive or wrong.

    An unknown product (a NULL factor) proves nothing wrong, so a positive
    recorded amount stands.
    """
    expected = f"{quantity} * abs({price})"
    return f"if({sales} > 0 AND coalesce({sales} = {expected}, true), {sales}, {expected})"


def repaired_price(sales: str, quantity: str, price: str) -> str:
    """Recorded price, or the whole-number quotient of the recorded amount."""
    return f"if({price} > 0, {price}, CAST({sales} div nullif({quantity}, 0) AS int))"
