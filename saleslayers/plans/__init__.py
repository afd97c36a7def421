"""The three layers as plans: raw tables, refined tables, reports."""
