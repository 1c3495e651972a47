"""shelfline: stock-movement analytics as lazy Spark plans.

Raw item, vendor, supply and movement records become three dimensions and a
daily inventory fact; KPI and dashboard queries read that star.
"""
