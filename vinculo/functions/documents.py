"""Brazilian identity numbers: CPF (people) and CNPJ (companies)."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F

from vinculo.functions.binding import let
from vinculo.functions.text import digits_only

CPF_LENGTH = 11


def _check_digit(digits: Column, covered: int) -> Column:
    """Modulus-11 check digit over the first ``covered`` digits, weights counting down to 2."""
    terms = [
        (F.ascii(F.substring(digits, position, 1)) - F.ascii(F.lit("0"))) * (covered + 2 - position)
        for position in range(1, covered + 1)
    ]
    remainder = reduce(add, terms) * 10 % 11
    return F.when(remainder == 10, 0).otherwise(remainder)


def clean_cpf(text: Column) -> Column:
    """The 11 digits of a valid CPF, the empty string for any other value, null for null."""

    def checked(digits: Column) -> Column:
        all_equal = F.repeat(F.substring(digits, 1, 1), F.lit(CPF_LENGTH)) == digits
        valid = (
            (F.length(digits) == CPF_LENGTH)
            & ~all_equal
            & (_check_digit(digits, CPF_LENGTH - 2) == F.substring(digits, 10, 1).try_cast("int"))
            & (_check_digit(digits, CPF_LENGTH - 1) == F.substring(digits, 11, 1).try_cast("int"))
        )
        return F.when(digits.isNull(), None).when(valid, digits).otherwise("")

    return let(digits_only(text), checked)


def roster_fragment(text: Column) -> Column:
    """Middle six digits of a complete CPF, else the empty string; null stays null."""
    return F.regexp_extract(digits_only(text), "^[0-9]{3}([0-9]{6})[0-9]{2}", 1)


def registry_fragment(digits: Column) -> Column:
    """Middle six digits of a partner document; a masked one (6 to 10 digits) yields its last six."""
    return (
        F.when(digits.isNull(), None)
        .when(F.length(digits) >= CPF_LENGTH, F.substring(digits, 4, 6))
        .when(F.length(digits) >= 6, F.right(digits, F.lit(6)))
        .otherwise("")
    )


def full_company_number(root: Column, order: Column, check: Column) -> Column:
    """Root, order and check digits joined; null if any part is null."""
    return F.concat(root, order, check)
