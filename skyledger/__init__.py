"""Build, load, lay out and summarise large measurement tables with Spark.

Every function takes and returns DataFrames (or Columns) and runs in the
caller's session: nothing here starts, configures or stops a session.
"""
