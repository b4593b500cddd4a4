"""School reporting on Spark: KPI reports, student features, models and a star schema.

Every operator takes DataFrames and returns a DataFrame on the caller's session.
"""
