"""Model fits, bundles and searches on MLlib."""
