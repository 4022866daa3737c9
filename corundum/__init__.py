"""Corundum: curation of quantum-chemistry molecule collections as plain PySpark DataFrame transformations."""
