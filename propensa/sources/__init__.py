from propensa.sources.tables import TABLES, load, events
from propensa.sources.clustered import read_clustered, write_clustered
from propensa.sources.sinks import write_partitioned, write_csv

__all__ = ["TABLES", "load", "events", "write_partitioned", "write_csv",
           "read_clustered", "write_clustered"]
