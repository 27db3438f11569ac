"""The taxi configuration: silver, gold, quality, insights and the monthly run."""
