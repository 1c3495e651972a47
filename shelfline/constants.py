"""Results must equal these texts and numbers exactly."""

# Exchange rate applied to stored values.
CURRENCY_RATE = 15000

# Coverage bands in days.
COVERAGE_LOW = 14
COVERAGE_HIGH = 30

# Band labels of the KPI computed from base quantities.
BAND_RAW = ("GREEN (Safe)", "YELLOW (Reorder Warning)", "RED (Urgent Stockout Risk)")

# Band labels of the KPI read from stored metrics.
BAND_STORED = ("GREEN (Aman)", "YELLOW (Beli Baru)", "RED (Kritis - Risiko Kosong)")

# Age groups in display order.
AGE_GROUPS = ("0-17", "18-30", "31-45", "46-60", "60+")
