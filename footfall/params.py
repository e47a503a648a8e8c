"""Run parameters of the registered queries (chosen so every query has rows; see FIXTURES.md)."""

from footfall.functions.slices import last_n_slices, stay_range, until_now_slices

AS_OF = "202401101205"              # reports: 2024-01-10 12:05, slices 00:05 .. 12:05
UNTIL_NOW = until_now_slices(AS_OF)
LAST_N_AS_OF = "202401100017"       # crosses midnight: 00:15 back to 23:20 the day before
LAST_N = 12
LAST_N_STAMPS = last_n_slices(LAST_N_AS_OF, LAST_N)
RES_START = "2024010723"            # a Sunday, 23h
RES_DAYS_SIGNAL = 1                 # residence removed from the reports (signal)
RES_DAYS_DENSE = 3                  # residents / staff on signal_dense
STAY_RANGE_SIGNAL = stay_range(RES_START, RES_DAYS_SIGNAL)
STAY_RANGE_DENSE = stay_range(RES_START, RES_DAYS_DENSE)
WEEK_RANGE_DAYS = 5
ROLLING_N = 3                       # slices per run of the rolling job
JOB_FIRST_AS_OF = "202401101150"    # visitor_job: rebuild at 11:50, then the 12:05 run
JOB_LATER = ["202401101220", "202401101235"]  # job_rerun_older: later runs, then 12:05 again
STREAM_EXTRA = ["202401101210", "202401101215"]  # stream_restarted: a slice of bad lines, an empty one
CELL_LOAD_HOUR = 2024011018
X_STAY_SECONDS = 4 * 3600
