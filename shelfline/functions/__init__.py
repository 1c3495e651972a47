from shelfline.functions.dates import calendar_columns, parse_day
from shelfline.functions.numeric import money, number, quantity, ratio, round2, whole

__all__ = ["calendar_columns", "money", "number", "parse_day", "quantity", "ratio", "round2", "whole"]
