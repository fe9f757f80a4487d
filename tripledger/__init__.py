"""Trip KPI engine: raw trip files in, audited KPI tables out, as plain PySpark DataFrame code."""
