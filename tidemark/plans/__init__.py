"""Feature blocks, mart assembly, run control and the driver-table role mapping."""
