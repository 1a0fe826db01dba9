"""The daily jobs as streams: the same operators behind foreachBatch, and windows with late arrivals."""
