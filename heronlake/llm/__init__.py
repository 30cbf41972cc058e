"""Operators for preparing large text corpora; nothing else in heronlake imports this subpackage."""
