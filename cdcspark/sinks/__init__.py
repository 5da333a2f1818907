from cdcspark.sinks.catalog import CatalogTarget, merge_into, merge_statement
from cdcspark.sinks.database import DatabaseTarget, Statements, jdbc_append, jdbc_load
from cdcspark.sinks.store import Store, Version, bucket_of
from cdcspark.sinks.target import Batch, CommitConflict, Position, State, Target
