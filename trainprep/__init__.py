"""trainprep: language-model training-data preparation as Spark DataFrame
operators (sources, chat rendering, curation, packing, token tables, log
tables, chat exports, dialogues, sinks).  See README.md."""

__version__ = "0.1.0"
