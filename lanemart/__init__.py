"""Wide freight-marketplace marts, built from reusable DataFrame operators."""
