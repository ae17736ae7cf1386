"""Composed jobs: lazy layer views, the medallion runs and the query catalog."""
