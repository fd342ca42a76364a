"""casegrain.sources"""
