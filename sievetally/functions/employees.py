"""Column functions for employee records."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

# Results depend on these exact patterns, cuts and words.
EMAIL_PATTERN = r"^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}$"
CURRENCY_PATTERN = "[₹$,]"
JUNIOR_BELOW = 50000
MID_UP_TO = 80000
DAYS_PER_YEAR = 365


def evaluation_date(as_of: date | str | None) -> Column:
    """One date for a whole run; None takes the day the query is planned."""
    if as_of is None:
        return F.current_date()
    return F.lit(as_of).cast("date")


def is_valid_email(email: Column) -> Column:
    return email.rlike(EMAIL_PATTERN)


def is_hired_by(hire_date: Column, as_of) -> Column:
    """The evaluation day itself counts as hired."""
    return hire_date <= evaluation_date(as_of)


def standardize_name(name: Column) -> Column:
    """Capitals at whitespace only: hyphens and apostrophes do not start a word."""
    return F.initcap(F.lower(name))


def salary_text(salary: Column) -> Column:
    return F.regexp_replace(salary, CURRENCY_PATTERN, "")


def clean_salary(salary: Column) -> Column:
    """Text that is still no number becomes null instead of failing the job."""
    return salary_text(salary).try_cast("decimal(10,2)")


def salary_band(salary: Column) -> Column:
    """A null salary fails both comparisons and so is Senior; that is the established meaning."""
    return F.when(salary < JUNIOR_BELOW, "Junior").when(salary <= MID_UP_TO, "Mid").otherwise("Senior")


def full_name(first: Column, last: Column) -> Column:
    return F.trim(F.concat_ws(" ", first, last))


def normalize_email(email: Column) -> Column:
    return F.lower(email)


def email_domain(email: Column) -> Column:
    """Null when there is no @."""
    return F.get(F.split(email, "@"), F.lit(1))


def age_years(birth_date: Column, as_of) -> Column:
    """Whole 365-day years, not calendar age; a birth date in the future gives a negative age."""
    return F.floor(F.datediff(evaluation_date(as_of), birth_date) / DAYS_PER_YEAR).cast("int")


def exact_tenure(hire_date: Column, as_of) -> Column:
    return F.datediff(evaluation_date(as_of), hire_date) / DAYS_PER_YEAR


def tenure_years(hire_date: Column, as_of) -> Column:
    """365-day years with one decimal; null from 99.95 years on, which the column cannot hold."""
    return exact_tenure(hire_date, as_of).try_cast("decimal(3,1)")


def normalize_status(status: Column) -> Column:
    """Only 'inactive' in any case is Inactive; null and unknown words are Active."""
    return F.when(F.lower(status) == "inactive", "Inactive").otherwise("Active")
