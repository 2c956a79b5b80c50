"""Fixed values of the source job (kept together; the operators take them as
parameter defaults).

  active        isinactive = 'false'
  north         0 <= bearing <= 45, or bearing >= 315
  train         vtype = 5
  delayed       delay > 0
  top N         5
  windowed top  3-minute windows
  average       1-minute windows (the documentation says 3; 1 is what runs)
  gap           the last 10 reports of a unit
  snapshots     every 10 seconds (trains, top N since start)
  file roll     every 10 seconds
  watermark     0 seconds (timestamps taken as monotonous)
"""

ACTIVE_VALUE = "false"
NORTH_LOW = 0.0
NORTH_HIGH = 45.0
NORTH_WRAP = 315.0
TRAIN_VTYPE = 5
TOP_N = 5
TOP_WINDOW_MINUTES = 3
AVG_MINUTES = 1
GAP_REPORTS = 10
SNAPSHOT_INTERVAL = "10 seconds"
FILE_ROLL_INTERVAL = "10 seconds"
WATERMARK_DELAY = "0 seconds"
