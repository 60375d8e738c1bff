"""Calendar expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Names in calendar order, weeks start on Monday.
DAY_NAMES = {
    "english": ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"],
    "spanish": ["Lunes", "Martes", "Miércoles", "Jueves", "Viernes", "Sábado", "Domingo"],
    "french": ["Lundi", "Mardi", "Mercredi", "Jeudi", "Vendredi", "Samedi", "Dimanche"],
}
MONTH_NAMES = {
    "english": ["January", "February", "March", "April", "May", "June", "July",
                "August", "September", "October", "November", "December"],
    "spanish": ["Enero", "Febrero", "Marzo", "Abril", "Mayo", "Junio", "Julio",
                "Agosto", "Septiembre", "Octubre", "Noviembre", "Diciembre"],
    "french": ["Janvier", "Février", "Mars", "Avril", "Mai", "Juin", "Juillet",
               "Août", "Septembre", "Octobre", "Novembre", "Décembre"],
}


def date_key(moment: Column) -> Column:
    """Integer ``YYYYMMDD`` of a date or timestamp, by arithmetic only."""
    return F.year(moment) * 10000 + F.month(moment) * 100 + F.dayofmonth(moment)


def weekday_number(day: Column) -> Column:
    """1 for Monday to 7 for Sunday."""
    return F.weekday(day) + 1


def _name(names: list[str], position: Column) -> Column:
    return F.split_part(F.lit(",".join(names)), F.lit(","), position)


def day_name(day: Column, language: str = "english") -> Column:
    return _name(DAY_NAMES.get(language, DAY_NAMES["english"]), weekday_number(day))


def month_name(day: Column, language: str = "english") -> Column:
    return _name(MONTH_NAMES.get(language, MONTH_NAMES["english"]), F.month(day))


def semester(quarter: Column) -> Column:
    return F.when(quarter < 3, 1).otherwise(2)


def timestamp_or_null(value: Column) -> Column:
    """Timestamp without zone; null for text that is none."""
    return value.try_cast("timestamp_ntz")
