"""Bill input (export scan, finalisation, derived test bill) and table sinks."""
