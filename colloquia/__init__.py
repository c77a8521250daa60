"""colloquia: Spark-native preparation of register-aware translation corpora.

Every public function takes and returns DataFrames; nothing is collected to
the driver except tiny, size-bounded control values (a BPE round's winning
pair, a row count used as a parameter).
"""

__version__ = "0.1.0"
