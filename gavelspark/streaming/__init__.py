"""Change-feed and stateful operators."""
