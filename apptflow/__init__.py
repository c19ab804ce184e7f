"""apptflow: appointment-notification selection jobs on PySpark.

Every job is a function from DataFrames (and an explicit ``as_of`` time) to a
DataFrame.  Nothing here reads the clock and nothing sends a message: the
product of a run is a table, usually an outbox.
"""
