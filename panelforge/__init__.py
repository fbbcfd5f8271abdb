"""panelforge: a Spark-native loan-panel analytics engine.

Stages: ``process`` (raw loan records -> labelled monthly panel with look-back
features), ``sample`` (stratified train/test sets, economic enrichment, binary
encoding) and ``train`` (MLlib classifiers). Every stage is DataFrame code.
"""

__version__ = "0.1.0"
