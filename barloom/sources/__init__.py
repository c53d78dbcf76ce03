"""barloom.sources"""
